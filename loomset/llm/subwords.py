"""Subword ids of whole texts by a public tokenizer, with a bounded cache of encoded words.

``word_bpe_49k.json`` lower-cases, drops white space and never merges across it, so the ids of a
text are the ids of its space-separated words, one after the other. Words repeat far more often
than texts do; each worker process therefore encodes a word once and looks it up afterwards. New
words go to the tokenizer many at a time, as one text.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

# The marker that a vocabulary's special tokens start with; words with it go to the tokenizer whole.
_SPECIAL = b"<|"
# Lead bytes of the marks that may join a letter of ASCII (U+0300 to U+037F), some only a small one.
_MARKS = (b"\xcc", b"\xcd")
# ASCII signs: the tokenizer's own pattern cuts a word where they follow a letter or digit. The
# apostrophe is not among them, since contractions have rules of their own.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Stands between words that go to the tokenizer as one text; words that hold it go alone.
_BETWEEN = b"\x01"
#: Words that an encoder remembers: some 130 MB, which worker processes hold between stages too.
CACHED_WORDS = 300_000
#: Words that go to the tokenizer as one text.
JOINED = 512
#: Bytes of texts that are encoded at once.
PORTION = 1 << 20


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def words_of(raw: bytes) -> list[bytes]:
    """Words of a text with the same ids as its own, A-Z lower-cased where no id can depend on it."""
    if _SPECIAL in raw or any(mark in raw for mark in _MARKS):
        return raw.split()
    return raw.lower().split()


def portions(texts: Iterable[tuple[object, bytes]]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Keys and words of texts, in portions of some ``PORTION`` bytes."""
    keys, words, held = [], [], 0
    for key, raw in texts:
        keys.append(key)
        words.append(words_of(raw))
        held += len(raw)
        if held >= PORTION:
            yield keys, words
            keys, words, held = [], [], 0
    if keys:
        yield keys, words


class WordEncoder:
    """Encodes words to ids, held as bytes of little-endian 32-bit numbers.

    ``limit`` bounds the cached words, and parts of words; a full cache keeps the words of the
    texts at hand only.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        # Ids that end a piece, which the vocabulary marks by a suffix.
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        between = self._whole([_BETWEEN])[0]
        self.between = int(between[0]) if len(between) == 1 else None
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def _make_room(self, used: set[bytes]) -> None:
        known = self.words
        kept = [word for word in used if word in known] if len(used) <= self.limit // 2 else []
        self.words, self.parts = {word: known[word] for word in kept}, {}

    def _whole(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts by the tokenizer itself."""
        found = self.tokenizer.encode_batch_fast([text.decode("utf-8") for text in texts], add_special_tokens=False)
        return [np.array(text.ids, "<u4") for text in found]

    def _joined(self, words: list[bytes], letters: bool) -> list[bytes]:
        """Ids of words, many as one text: cut where pieces end if all are letters, else at a sign between them."""
        groups = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        glue = b" " if letters else b" " + _BETWEEN + b" "
        coded = []
        for own, ids in zip(groups, self._whole([glue.join(own) for own in groups])):
            # A word of letters is one piece; if the pattern sees more in any, there are too many ends.
            ends = np.flatnonzero(self.final[ids]) + 1 if letters else np.append(np.flatnonzero(ids == self.between), len(ids))
            if len(ends) != len(own):
                coded += [ids.tobytes() for ids in self._whole(own)]
                continue
            raw, ends = ids.tobytes(), (4 * ends).tolist()
            starts = [0, *(ends if letters else [end + 4 for end in ends])]
            coded += [raw[start:end] for start, end in zip(starts, ends)]
        return coded

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        letters, others, alone = [], [], []
        for word in words:
            if word.isalpha() or (not word.isascii() and word.decode("utf-8").isalpha()):
                letters.append(word)
            elif _SPECIAL in word or _BETWEEN in word or self.between is None:
                alone.append(word)
            else:
                others.append(word)
        found = [*self._joined(letters, True), *self._joined(others, False), *(ids.tobytes() for ids in self._whole(alone))]
        return dict(zip([*letters, *others, *alone], found))

    def _learn(self, new: list[bytes]) -> None:
        """Add words that the cache lacks; signs at their ends are parts of their own."""
        known, parts = self.words, self.parts
        single, split, lacking = [], [], {}
        for raw in new:
            if not raw.isalpha():
                base = raw.rstrip(_SIGNS)
                last = base[-1:]
                if len(base) < len(raw) and (last.isalnum() or (base[-2:-1] == b"\xc3" and last not in b"\x97\xb7")) and _SPECIAL not in raw:
                    tail = raw[len(base) :]
                    split.append((raw, base, tail))
                    for part in (base, tail):
                        if part not in known and part not in parts:
                            lacking[part] = None
                    continue
            if raw in parts:
                known[raw] = parts[raw]
            else:
                single.append(raw)
                lacking[raw] = None
        found = self._encoded(list(lacking))
        # A word without such signs is remembered as a word only.
        for raw in single:
            known[raw] = found.pop(raw)
        parts.update(found)
        for raw, base, tail in split:
            known[raw] = (known.get(base) or parts[base]) + (known.get(tail) or parts[tail])

    def _know(self, used: set[bytes]) -> None:
        new = used.difference(self.words)
        if new and max(len(self.words), len(self.parts)) > self.limit:
            self._make_room(used)
            new = used.difference(self.words)
        if new:
            self._learn(list(new))

    def coded(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of the words of each text, as bytes."""
        self._know(set(chain.from_iterable(texts)))
        known = self.words
        return [b"".join(map(known.__getitem__, words)) for words in texts]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text (null: none)."""
        ids = self.coded([words_of((text or "").encode("utf-8", "replace"))])[0]
        return np.frombuffer(ids, "<u4")

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in order, and how many ids each word has."""
        self._know(set(words))
        coded = list(map(self.words.__getitem__, words))
        return np.frombuffer(b"".join(coded), "<u4"), np.fromiter(map(len, coded), np.int64, len(coded)) // 4


@lru_cache(maxsize=2)
def encoder(path: str, limit: int = CACHED_WORDS) -> WordEncoder:
    """One encoder per worker process, vocabulary and size of the cache."""
    return WordEncoder(path, limit)
