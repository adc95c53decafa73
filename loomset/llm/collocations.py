"""Phrase collocations: frequent phrases of a few words and how firmly their words hold together.

Every word occurrence is the pointer to a suffix of its piece of text, read to ``most`` words at most.
Words are counted first. Suffixes are then routed over the whole table by their leading words: by the
first word; where that word alone is too frequent for one task, by the first two; and so on. A word or
phrase is routed deeper if it makes up at least one in ``FANOUT`` of all words; there are at most so
many per length, which bounds the broadcast that tells them, and no route has a larger share of the
table, whatever the skew. Leading words that are infrequent are abandoned here, as far as a bitmap of
fixed size can tell them. A task counts the equal suffixes of a portion before it sends them, so a
phrase that is repeated a lot, copies of whole texts included, moves once per portion. A portion's
suffixes for one task travel as one row: its words, once, and numbers into them.

Each routed partition is sorted by multikey three-way quicksort of suffix pointers: a partition of
pointers is split by its pivot's word into smaller, equal and greater; the equal ones agree in all words
up to here, so their number is the phrase's count, and they are sorted on by the next word. A partition
whose pointers count less than ``least`` together is abandoned, since nothing in it can be frequent.

Scores are exact integers: the products are decimals of 38 digits, which holds for phrases counted
below 10**12 times and parts below 10**15; beyond that the query fails rather than rounds.

Defined results: a null text is empty; a null language is ``und``; pieces without words give nothing;
repeated rows count each; ties are ranked by count, then by the phrase's UTF-8 bytes; bytes that are no
UTF-8 are compared as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import stored

LEAST = 10
MOST = 3
TOP = 2_000
#: A longer phrase takes a shorter one's place from this share of its count on, in percent.
INSIDE = 50
SCALE = 1_000_000
#: Words that a task counts at once.
PORTION = 1 << 19
#: Phrases per length that may be routed deeper, since each is at least that share of all words.
FANOUT = 1 << 17
#: Words per sorting task.
SORTED = 1 << 20
#: Pointers that are sorted without further partitioning.
SMALL = 1 << 12
#: Bits that tell frequent words, by hash; a word that shares its bit with a frequent one stays.
BITS = 1 << 24
_BITMAP = 1 << 15  # bits of one of Spark's bitmaps
SEED = 42

# The signs that end a piece. All become a full stop, which no word then holds.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(_ENDS, b"." * len(_ENDS))


def _words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a text, and ``b"."`` wherever a piece ends."""
    return text.lower().translate(_TO_STOP).replace(b".", b" . ").split()


def lang_seed(lang: str) -> int:
    """The seed with which a word's XXH64 is what Spark's ``xxhash64`` gives for language and word."""
    return xxhash.xxh64_intdigest(lang.encode(), SEED)


class _Numbers(dict):
    """Numbers of one language's words; a new word takes the portion's next one."""

    def __init__(self, words: list[bytes]):
        self[b"."] = 0
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


class _Portion:
    """Suffixes of some texts as word numbers; 0 stands for the end of a piece."""

    def __init__(self, most: int):
        self.most = most
        self.words: list[bytes] = [b"."]
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.pointers: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, words: list[bytes], own: int) -> None:
        """Words of one language; the first ``own`` of them are pointed at, the rest only read."""
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(self.words)
        ids = np.zeros(len(words) + self.most, np.int64)  # as if a piece ended after the words
        ids[: len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        pointed = np.zeros(len(ids), bool)
        pointed[:own] = ids[:own] > 0
        self.parts.append(ids)
        self.pointers.append(pointed)
        self.size += len(words)

    def langs(self) -> tuple[list[str], np.ndarray]:
        """All languages, and which one each word is of."""
        names, of = list(self.numbers), np.zeros(len(self.words), np.int64)
        for number, name in enumerate(names):
            of[np.fromiter(self.numbers[name].values(), np.int64)] = number
        return names, of

    def suffixes(self, wanted: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Word numbers of each different suffix, and how often it occurs.

        Of ``wanted`` words only: a suffix ends before the first other one, and one that has fewer than
        two words then is left out.
        """
        ids, pointed = np.concatenate(self.parts), np.concatenate(self.pointers)
        if wanted is not None:
            pointed &= wanted[ids]
            ids = np.where(wanted[ids], ids, 0)
        at = np.flatnonzero(pointed)
        columns, open_ = [ids[at]], np.ones(len(at), bool)
        for k in range(1, self.most):
            column = np.where(open_, ids[at + k], 0)
            open_ = column > 0
            columns.append(column)
        if wanted is not None:
            two = columns[1] > 0
            columns = [column[two] for column in columns]
        base = len(self.words)
        if base**self.most >= 1 << 62:
            rows, n = np.unique(np.stack(columns, 1), axis=0, return_counts=True)
            return list(rows.T), n
        code = columns[0]
        for column in columns[1:]:
            code = code * base + column
        code, n = np.unique(code, return_counts=True)
        columns = []
        for _ in range(self.most):
            code, column = np.divmod(code, base)
            columns.insert(0, column)
        return columns, n


def _portions(batches: Iterator[pa.RecordBatch], most: int, size: int) -> Iterator[_Portion]:
    portion = _Portion(most)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words = _words_of(text.as_buffer().to_pybytes()) if text.is_valid else []
            for at in range(0, len(words), size):
                portion.add(lang, words[at : at + size + most - 1], min(size, len(words) - at))
                if portion.size >= size:
                    yield portion
                    portion = _Portion(most)
    if portion.size:
        yield portion


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _names(most: int) -> list[str]:
    return [f"w{k}" for k in range(1, most + 1)]


def _word_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for portion in _portions(batches, 1, size):
        (own,), n = portion.suffixes()
        names, of = portion.langs()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(of[own])), pa.array(portion.words, pa.binary()).take(pa.array(own)), pa.array(n)],
            names=["lang", "w1", "n"],
        )


def count_words(docs: DataFrame, size: int = PORTION) -> DataFrame:
    """``(lang, w1, n)`` of all words. ``docs``: lang, text."""
    counted = _texts(docs).mapInArrow(lambda b: _word_rows(b, size), "lang string, w1 binary, n long")
    return counted.groupBy("lang", "w1").agg(F.sum("n").alias("n"))


def frequent_bits(words: DataFrame, least: int, bits: int = BITS) -> np.ndarray:
    """A bit per hash value that a frequent word has: ``bits / 8`` bytes reach the driver."""
    place = F.pmod(F.xxhash64("lang", "w1"), F.lit(bits))
    found = words.where(F.col("n") >= least).select(
        F.floor(place / _BITMAP).alias("bucket"), F.pmod(place, F.lit(_BITMAP)).alias("bit")
    )
    maps = found.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    table = np.zeros(bits // 8, np.uint8)
    for row in maps.toLocalIterator():
        at = row["bucket"] * _BITMAP // 8
        table[at : at + _BITMAP // 8] = np.frombuffer(row["map"], np.uint8)
    return table


@dataclass
class Routing:
    """What a task must know to route suffixes: frequent words' bits, and heavy phrases by length."""

    bits: np.ndarray
    tasks: int
    heavy: list[set[tuple]] = field(default_factory=list)  # (lang, word, ..) of 1, 2, .. words

    def marked(self, portion: _Portion, names: list[str], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of a portion, and whether it may be frequent."""
        seeds = [lang_seed(name) for name in names]
        hashes = np.array([xxhash.xxh64_intdigest(w, seeds[k]) for w, k in zip(portion.words, of.tolist())], np.uint64)
        place = (hashes % np.uint64(8 * len(self.bits))).astype(np.int64)
        wanted = (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
        wanted[0] = False
        return hashes, wanted

    def hot(self, portion: _Portion, names: list[str], of: np.ndarray) -> np.ndarray:
        """Which words of a portion are heavy."""
        known = self.heavy[0] if self.heavy else ()
        found = np.array([(names[k], w) in known for w, k in zip(portion.words, of.tolist())], bool)
        found[0] = False
        return found

    def depth(self, portion: _Portion, names: list[str], of: np.ndarray, columns: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
        """By how many leading words each suffix is routed. Suffixes come sorted, so equal prefixes are
        neighbours and each is asked for once."""
        depth = np.ones(len(columns[0]), np.int64)
        rows = np.flatnonzero(hot[columns[0]])
        depth[rows] = 1 + bool(self.heavy)
        for length, heavy in enumerate(self.heavy[1:], 2):
            rows = rows[hot[columns[length - 1][rows]]]  # all words of a heavy phrase are heavy
            prefix = [column[rows] for column in columns[:length]]
            new = np.ones(len(rows), bool)
            new[1:] = np.any([column[1:] != column[:-1] for column in prefix], axis=0)
            words = [column[new].tolist() for column in prefix]
            langs = of[prefix[0][new]].tolist()
            deep = [(names[k], *(portion.words[i] for i in own)) in heavy for k, *own in zip(langs, *words)]
            rows = rows[np.repeat(np.array(deep, bool), np.diff(np.flatnonzero(new), append=len(rows)))]
            depth[rows] = length + 1
        return depth


def _heavier(batches: Iterator[pa.RecordBatch], routing: Routing, size: int) -> Iterator[pa.RecordBatch]:
    """Counts of the heavy phrases of greatest length with one heavy word more."""
    length = len(routing.heavy) + 1
    for portion in _portions(batches, length, size):
        names, of = portion.langs()
        hot = routing.hot(portion, names, of)
        columns, n = portion.suffixes(hot)
        rows = np.flatnonzero((routing.depth(portion, names, of, columns, hot) == length) & (columns[-1] > 0))
        words = pa.array(portion.words, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()).take(pa.array(of[columns[0][rows]])),
                *(words.take(pa.array(column[rows])) for column in columns),
                pa.array(n[rows]),
            ],
            names=["lang", *_names(length), "n"],
        )


def _routed(batches: Iterator[pa.RecordBatch], routing: Routing, most: int, size: int) -> Iterator[pa.RecordBatch]:
    """A row per portion, sorting task and language: words joined by blanks, and an int32 matrix of
    route depths, word places (from 1; 0 is the end) and counts, column by column."""
    for portion in _portions(batches, most, size):
        names, of = portion.langs()
        hashes, wanted = routing.marked(portion, names, of)
        columns, n = portion.suffixes(wanted)
        depth = routing.depth(portion, names, of, columns, routing.hot(portion, names, of))
        route = np.zeros(len(n), np.uint64)
        whole = np.ones(len(n), bool)
        for k, column in enumerate(columns):
            used = depth > k
            # A suffix that ends before the word it is routed by was counted with the heavy ones.
            whole &= ~used | (column > 0)
            route = np.where(used, (route ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15), route)
        task = ((route >> np.uint64(20)) % np.uint64(routing.tasks)).astype(np.int64)
        cell = np.where(whole, task * len(names) + of[columns[0]], -1)
        order = np.argsort(cell, kind="stable")
        order = order[np.searchsorted(cell[order], 0) :]
        cuts = np.flatnonzero(np.diff(cell[order], prepend=-1, append=-1)) if len(order) else []
        out: list[list] = [[], [], [], []]
        for first, last in zip(cuts[:-1], cuts[1:]):
            rows = order[first:last]
            used, at = np.unique(np.stack([column[rows] for column in columns]), return_inverse=True)
            at = at.reshape(most, -1)
            if used[0] > 0:
                at, used = at + 1, np.concatenate([[0], used])
            task_of, lang = divmod(int(cell[rows[0]]), len(names))
            matrix = np.concatenate([depth[rows][None], at, n[rows][None]]).astype("<i4")
            for column, value in zip(out, (task_of, names[lang], b" ".join([portion.words[i] for i in used[1:]]), matrix.tobytes())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.string(), pa.binary(), pa.binary()))],
            names=["task", "lang", "words", "suffixes"],
        )


Found = tuple[int, np.ndarray, np.ndarray]


def sort_pointers(keys: list[np.ndarray], weight: np.ndarray, least: int, small: int = SMALL) -> Iterator[Found]:
    """Multikey three-way quicksort: every frequent equal partition as depth, pointer and count.

    ``keys[d]`` is the word number at depth d of each suffix, negative behind its end; ``weight`` says
    how often the suffix was counted. The pointer is one of the partition's. Partitions of at most
    ``small`` pointers are sorted at once by all the words they have left, as quicksorts do.
    """
    open_ = [(np.arange(len(weight)), 0)] if int(weight.sum()) >= least else []
    while open_:
        at, depth = open_.pop()
        if len(at) <= small:
            yield from _sort_small(keys, weight, least, at, depth)
            continue
        words = keys[depth][at]
        # The middle one of some nine words spread over the partition.
        sample = np.sort(words[:: len(words) // 9 or 1])
        pivot = sample[len(sample) // 2]
        equal = words == pivot
        same = at[equal]
        count = int(weight[same].sum())
        if count >= least and pivot >= 0:
            yield depth, same[:1], np.array([count])
            if depth + 1 < len(keys):
                open_.append((same, depth + 1))
        if len(same) < len(at):
            less = words < pivot
            for rest in (at[less], at[~(less | equal)]):
                if len(rest) and int(weight[rest].sum()) >= least:
                    open_.append((rest, depth))


def _sort_small(keys: list[np.ndarray], weight: np.ndarray, least: int, at: np.ndarray, depth: int) -> Iterator[Found]:
    left = [key[at] for key in keys[depth:]]
    order = np.lexsort(left[::-1])
    at, left = at[order], [column[order] for column in left]
    new = np.zeros(len(at), bool)
    new[:1] = True
    for deeper, column in enumerate(left):
        new[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(new)
        counts = np.add.reduceat(weight[at], first)
        frequent = (counts >= least) & (column[first] >= 0)
        if frequent.any():
            yield depth + deeper, at[first[frequent]], counts[frequent]


def _sorted(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of one routed partition."""
    langs: dict[str, int] = {}
    numbers: dict[str, _Numbers] = {}
    words: list[bytes] = [b"."]
    parts = []
    for batch in batches:
        for lang, own, blob in zip(batch.column("lang").to_pylist(), batch.column("words"), batch.column("suffixes")):
            known = numbers.get(lang)
            if known is None:
                langs[lang] = len(langs)
                known = numbers[lang] = _Numbers(words)
            place = np.array([-1, *map(known.__getitem__, own.as_buffer().to_pybytes().split(b" "))], np.int32)
            matrix = np.frombuffer(blob.as_buffer(), "<i4").reshape(most + 2, -1)
            # Routes of different depth are kept apart: they do not share phrases they can count.
            group = matrix[0] + langs[lang] * (most + 1)
            parts.append(np.concatenate([group[None], place[matrix[1:-1]], matrix[-1:]]))
    if not parts:
        return
    table = np.concatenate(parts, 1)
    del parts
    names = list(langs)
    found: list[list] = [[], [], []]
    for depth, pointers, counts in sort_pointers(list(table[:-1]), table[-1].astype(np.int64), least):
        told = depth >= np.maximum(2, table[0, pointers] % (most + 1))
        rows = table[: depth + 1, pointers[told]].T.tolist()
        found[0] += [names[group // (most + 1)] for group, *_ in rows]
        found[1] += [[words[i] for i in own] for _, *own in rows]
        found[2] += counts[told].tolist()
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.list_(pa.binary()), pa.int64()))], names=["lang", "parts", "f"]
    )


def count_phrases(
    docs: DataFrame, words: DataFrame, total: int, most: int = MOST, least: int = LEAST,
    size: int = PORTION, fanout: int = FANOUT, bits: int = BITS,
) -> DataFrame:
    """``(lang, parts, f)`` of all phrases of 2 to ``most`` words counted ``least`` times or more.

    ``words`` as :func:`count_words` gives them, stored; ``total`` is the sum of their counts.
    """
    texts, limit = _texts(docs), max(-(-total // fanout), least)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SORTED))
    routing = Routing(frequent_bits(words, least, bits), tasks)
    heavy, known = words.where(F.col("n") >= limit), []
    for length in range(1, most):
        rows = heavy.select("lang", *_names(length)).collect()  # at most fanout
        if not rows:
            break
        routing.heavy.append({(lang, *map(bytes, own)) for lang, *own in rows})
        if length + 1 < most:
            now = Routing(routing.bits, tasks, list(routing.heavy))
            schema = ", ".join(["lang string", *(f"{name} binary" for name in _names(length + 1)), "n long"])
            longer = texts.mapInArrow(lambda b, now=now: _heavier(b, now, size), schema)
            counted = longer.groupBy("lang", *_names(length + 1)).agg(F.sum("n").alias("n")).where(F.col("n") >= limit)
            heavy = stored(counted, "heavy-phrases")
            known.append(heavy.select("lang", F.array(*_names(length + 1)).alias("parts"), F.col("n").alias("f")))
    routed = texts.mapInArrow(lambda b: _routed(b, routing, most, size), "task int, lang string, words binary, suffixes binary")
    spread = routed.repartitionById(tasks, "task")
    found = spread.mapInArrow(lambda b: _sorted(b, most, least), "lang string, parts array<binary>, f long")
    return reduce(DataFrame.unionByName, known, found)


def _phrase(words: Column) -> Column:
    """Words joined by blanks. Casts and joins leave the bytes as they are."""
    return F.array_join(words.cast("array<string>"), " ")


def _look_up(rows: DataFrame, part: str, counts: DataFrame, heavy: DataFrame, name: str) -> DataFrame:
    """Add the count of the phrase in column ``part``. Heavy phrases, which many rows may share, are
    broadcast; every other is a part of few rows."""
    def named(table: DataFrame) -> DataFrame:
        return table.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))

    own = F.broadcast(named(heavy))
    light = rows.join(own, ["lang", part], "left_anti")
    return rows.join(own, ["lang", part]).unionByName(light.join(named(counts), ["lang", part]))


def mine(
    docs: DataFrame, most: int = MOST, least: int = LEAST, top: int = TOP, inside: int = INSIDE,
    size: int = PORTION, fanout: int = FANOUT,
) -> DataFrame:
    """The ``top`` firmest phrases per language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the two sides of its weakest cut, ``n`` the language's words.
    ``docs`` has ``lang`` and ``text``.
    """
    words = stored(count_words(docs, size), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    phrases = stored(count_phrases(docs, words, total, most, least, size, fanout), "phrases").select(
        "lang", _phrase(F.col("parts")).alias("phrase"), "parts", F.size("parts").alias("size"), F.col("f").alias("a")
    )
    single = words.where(F.col("n") >= least).select("lang", F.col("w1").cast("string").alias("phrase"), F.col("n").alias("f"))
    counts = single.unionByName(phrases.where(F.col("size") < most).select("lang", "phrase", F.col("a").alias("f")))
    heavy = F.col("f") >= max(-(-total // fanout), least)

    cuts = phrases.select("lang", "phrase", "a", "parts", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        _phrase(F.slice("parts", 1, F.col("k"))).alias("first"),
        _phrase(F.slice("parts", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"),
    )
    for part, side in (("first", "l"), ("rest", "r")):
        cuts = _look_up(cuts, part, counts.where(~heavy), counts.where(heavy), side)
    narrow, wide = F.col("a").cast("decimal(12,0)"), [F.col(side).cast("decimal(15,0)") for side in "lr"]
    cuts = cuts.withColumns({"over": F.lit(SCALE).cast("decimal(7,0)") * (narrow * narrow), "under": wide[0] * wide[1]})
    cuts = cuts.withColumn("score", F.expr("over div under").cast("long"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))

    # The most frequent longer phrase around a phrase decides whether it takes its place.
    spans = [(start, count) for count in range(2, most) for start in range(1, most - count + 2)]
    if spans:
        fits = [F.when(F.col("size") >= max(start + count - 1, count + 1), _phrase(F.slice("parts", start, count))) for start, count in spans]
        around = phrases.where("size > 2").select("lang", F.explode(F.array(*fits)).alias("phrase"), "a")
        around = around.where("phrase is not null").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        weakest = weakest.join(around, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("longer") < inside * F.col("cut.a"), F.lit(True))
        )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = weakest.select("lang", "phrase", "cut.*").withColumn("rank", F.row_number().over(order))
    per_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(per_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
