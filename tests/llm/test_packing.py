import random
import tracemalloc
import zlib

import numpy as np
import pytest

from loomset.llm import packing
from loomset.llm.common import stored
from loomset.llm.subwords import WordEncoder, vocabulary_path

from .conftest import ODD_TEXTS

PATH = vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coder():
    return WordEncoder(PATH, limit=50)


@pytest.mark.parametrize(
    "text", [*ODD_TEXTS, "don't DON'T İx ǅ ß ẞ ﬁ ½ ΑΣ Σας", "a1b22 c_d--e!!!", "<|startoftext|>x<|endoftext|>", "�́é", "x" * 5000]
)
def test_words_encode_like_whole_texts(coder, text):
    assert coder.encode(text).tolist() == coder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_random_texts_encode_like_whole_texts(coder):
    rng = random.Random(8)
    signs = "abcXYZéÄß '’.,!?-_<|>109 \n\t 日ñ😀"
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(60))
        assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_letters_are_remembered_once():
    coder = WordEncoder(PATH, limit=3000)
    coder.encode_words([f"w{a}{b}".encode() for a in "abcdefgh" for b in "ijklmnop"])
    assert len(coder.words) == 64 and not coder.parts
    for k in range(40):  # words of many parts fill the cache of parts first
        coder.encode("-".join("".join(chr(97 + (k * 200 + i) // 26**j % 26) for j in range(4)) for i in range(200)))
        assert len(coder.parts) <= coder.limit + 201


def plain_fill(plan):
    """Contents of every bin, from the plan's runs."""
    bins = {}
    for length, runs in plan.runs.items():
        ends = [r[0] for r in runs[1:]] + [plan.placed[length]]
        for (first, bin_, each, offset), end in zip(runs, ends):
            for rank in range(first, end):
                step, place = divmod(rank - first, each)
                bins.setdefault(bin_ + step, []).append((offset + place * length, length))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_everything_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    lengths = rng.choices(range(1, capacity + 1), k=rng.randrange(1, 60))
    histogram = {length: rng.randrange(1, 50) for length in lengths}
    plan = packing.plan_packing(histogram, capacity)
    assert plan.placed == histogram
    bins = plain_fill(plan)
    assert sorted(bins) == list(range(plan.bins))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(length > capacity // 3 for _, length in content) <= 2
    total = sum(k * n for k, n in histogram.items())
    assert plan.bins <= 11 / 9 * max(-(-total // capacity), sum(n for k, n in histogram.items() if 2 * k > capacity)) + 1


def test_packed_pieces_rebuild_the_documents(spark, documents):
    docs = documents(*((i, t) for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS])))
    pieces = stored(packing.tokenize_pieces(docs, capacity=64), "pieces")
    packed = packing.pack(pieces, capacity=64, cells=3)
    coder = WordEncoder(PATH)
    sequences = {r.sequence_id: r.ids for r in packing.build_sequences(packed).collect()}
    assert all(len(ids) <= 64 for ids in sequences.values())
    found = {}
    for r in packed.collect():
        ids = sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        found.setdefault(r.key, {})[r.start] = ids
    for key, text in docs.select("doc_id", "text").collect():
        ids = [i for start in sorted(found[key]) for i in found[key][start]]
        assert ids == [*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    assert sum(map(len, sequences.values())) == sum(r.length for r in packed.collect())


def test_empty_table(documents):
    pieces = packing.tokenize_pieces(documents((1, "x")).where("false"))
    assert packing.pack(pieces).count() == 0


def test_learned_words_take_little_memory():
    """Ids of words and of their parts are kept as bytes, not as lists of numbers."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)).encode() for _ in range(20_000)]
    coder = WordEncoder(PATH)
    tracemalloc.start()
    ids, sizes = coder.encode_words(words)
    held = tracemalloc.get_traced_memory()[0] - ids.nbytes - sizes.nbytes
    tracemalloc.stop()
    assert held < 350 * len(words)
    expected = coder.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    assert ids.tolist() == [i for e in expected for i in e.ids] and sizes.tolist() == [len(e.ids) for e in expected]


def test_new_words_go_to_the_tokenizer_together():
    """Many words make one text for it; letters of either case are one word; any sign may stand beside them."""
    coder = WordEncoder(PATH)

    class Counted:
        texts = 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    tokenizer, coder.tokenizer = coder.tokenizer, Counted()
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeéß", k=9)) for _ in range(2000)]
    text = " ".join([*words, *(w + "," for w in words), *(w.title() for w in words if w.isascii())])
    assert coder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.tokenizer.texts <= 10
    assert len(coder.words) == 2 * len(set(words))


def test_odd_words_encode_like_whole_texts():
    """Words that the tokenizer composes, splits or drops, beside each other in random order."""
    odd = [
        "J\u030c", "j\u030c", "H\u0331x", "T\u0308.", "\u0301a", "a\u0301,", "x\x01y", "\x01", "\x01\x01.", "<|endoftext|>", "<|ENDOFTEXT|>",
        "a<|", "|>", "\xa0", "\x85", "a\xa0b", "\u2003", "don't,", "DON'T!", "'s", "o'S.", "x'", "1,5.", "½.", "×,", "÷.", "a×,", "É!!", "İx,", "ﬁ.",
        "日本。", "日本,", "é-é", "\u1e9e.", "ΑΣ,", "\U0001f600,", "_a_", "\u200b", "\u0300", "\uac00,", "K,", "Å.", "ªb.", "Ǆ,", "ᾳ,", "\u0345", "ⅷ",
    ]
    rng = random.Random(9)
    for limit in (5, 1000):
        coder = WordEncoder(PATH, limit=limit)
        for _ in range(200):
            words = rng.choices(odd, k=30)
            text = " ".join(words)
            assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
            ids, sizes = coder.encode_words([w.encode() for w in words])
            expected = [coder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
            assert ids.tolist() == [i for own in expected for i in own] and sizes.tolist() == list(map(len, expected))
