"""Periodic runs of words, caught by dyadic square catchers.

A run of period q holds a stretch of at least q words that each equal the word q places on. Whenever
a block of 2**k words is complete (blocks begin at multiples of their size), it becomes a catcher
for the periods q from 2**(k+1) up to 2**(k+2); the smallest blocks also take the periods below. Each
stretch is long enough to cover a whole block of its level, so no run is missed. A word that is
appended completes, at every level, a suffix of the text; where that suffix equals a catcher's block
within the catcher's reach, the pair is caught. Catches of neighbouring blocks at one period join, and
suffix comparisons carry their two ends outwards by halves, fewer words than a block each. Stretches
that reach q words are squares, and squares that touch have merged into one run by then.

Blocks are compared by names, given level by level: a name stands for the pair of names of a block's
halves, so equal names mean equal words. Only what occurs twice in its text keeps a name, hence the
work is that of the repeats. A catcher of 2**k words sees at most 2**(k+1) suffixes, so a level makes
at most two catches per word (three and a half at the smallest) however periodic the text is. The
appended words of a task's portion are taken level by level instead of word by word, which finds the
same catches with numpy.

Defined results: a null or blank text has no words and no runs; rows that repeat are treated alike; a
text is never cut, whatever its length; bytes that are no UTF-8 pass as they are; an empty table gives
an empty table. Other columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words.
LEAST = 12
#: Words that are taken at once; a longer text is taken whole, alone.
PORTION = 1 << 17
#: Words of the smallest catchers, which take all periods below four times their size.
SMALLEST = 2

RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Rewrite = Callable[[list[bytes], object], list[bytes]]


class BlockNames:
    """Names of all blocks of 1, 2, 4, ... words at every place of a sequence of word ids.

    ``levels[k][i]`` names the 2**k words from ``i`` on; -1 where these words occur once only.
    """

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        often = np.bincount(ids) > 1 if len(ids) else np.zeros(0, bool)
        alive = np.flatnonzero(often[ids]) if len(ids) else np.zeros(0, np.int64)
        first = np.full(self.n, -1, np.int32)
        first[alive] = ids[alive]
        self.levels, self.alive = [first], [alive]
        half = 1
        while len(alive) and 2 * half <= self.n:
            below = self.levels[-1]
            pairs = alive[alive + half < self.n]
            pairs = pairs[below[pairs + half] >= 0]
            code = below[pairs].astype(np.int64) * (int(below.max()) + 1) + below[pairs + half]
            order = np.argsort(code, kind="stable")
            ranked = code[order]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            group = np.cumsum(new) - 1
            keep = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
            names = np.full(self.n, -1, np.int32)
            names[pairs[order[keep]]] = group[keep]
            alive = np.flatnonzero(names >= 0)
            self.levels.append(names)
            self.alive.append(alive)
            half *= 2

    def equal(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the 2**level words from ``a`` on equal those from ``b`` on; both must lie inside."""
        names = self.levels[level][a]
        return (names >= 0) & (names == self.levels[level][b])


def _catches(names: BlockNames, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Catchers' places and periods of all catches at a level."""
    size = 1 << level
    low, high = (1 if size == SMALLEST else 2 * size), 4 * size
    alive = names.alive[level]
    own = names.levels[level][alive]
    order = np.argsort(own, kind="stable")
    places, step = alive[order], 2 * names.n + high
    keyed = own[order].astype(np.int64) * step + places  # places rise within a name
    block = places % size == 0
    at, base = places[block], keyed[block]
    first, last = np.searchsorted(keyed, base + low), np.searchsorted(keyed, base + high)
    many = last - first
    block_at = np.repeat(at, many)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return block_at, places[np.repeat(first, many) + nth] - block_at


def _carry(names: BlockNames, level: int, at: np.ndarray, period: np.ndarray, ahead: bool) -> np.ndarray:
    """Move each place outwards while the words there equal those one period on."""
    at = at.copy()
    for below in range(level - 1, -1, -1):
        step = 1 << below
        if ahead:
            can = np.flatnonzero(at + period + step <= names.n)
            a = at[can]
        else:
            can = np.flatnonzero(at >= step)
            a = at[can] - step
        moved = can[names.equal(below, a, a + period[can])]
        at[moved] += step if ahead else -step
    return at


def find_runs(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of at least ``least`` words, by start, then period.

    ``ids`` stand for words; they must be small non-negative integers.
    """
    if least < 8:
        raise ValueError("runs under eight words are too short for the smallest catchers")
    names = BlockNames(ids)
    found = []
    for level in range(SMALLEST.bit_length() - 1, len(names.levels)):
        if not len(names.alive[level]):
            break
        size = 1 << level
        at, period = _catches(names, level)
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        joins = np.zeros(len(at) + 1, bool)
        joins[1:-1] = (period[1:] == period[:-1]) & (at[1:] == at[:-1] + size)
        heads, tails = ~joins[:-1], ~joins[1:]
        period = period[heads]
        start = _carry(names, level, at[heads], period, False)
        end = _carry(names, level, at[tails] + size, period, True)
        square = end - start >= np.maximum(period, least - period)
        found.append(np.stack([start, end - start + period, period])[:, square])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, 1)
    # A run shows at the multiples of its period too; the smallest one names it.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _portions(batch: pa.RecordBatch, rewrite: Rewrite | None) -> Iterator[list[list[bytes]]]:
    """Words of texts, in portions of some ``PORTION`` words."""
    part, held = [], 0
    keys = batch.column("__key").to_pylist() if rewrite else None
    for row, text in enumerate(batch.column("__text")):
        words = text.as_buffer().to_pybytes().split() if text.is_valid else []
        if rewrite:
            words = rewrite(words, keys[row])
        part.append(words)
        held += len(words)
        if held >= PORTION:
            yield part
            part, held = [], 0
    if part:
        yield part


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Ids of all words, one text after the other; texts share no id, so nothing repeats across them."""
    ids, used = [], 0
    for words in texts:
        own = {word: used + i for i, word in enumerate(dict.fromkeys(words))}
        used += len(own)
        ids.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
    return np.concatenate(ids)


def _run_rows(batches: Iterator[pa.RecordBatch], least: int, rewrite: Rewrite | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for texts in _portions(batch, rewrite):
            ids = _numbered(texts)
            start, length, period = find_runs(ids, least)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            ends = np.cumsum(sizes)
            begins = ends - sizes
            edge = np.zeros(len(ids) + 1, np.int32)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            owner = np.searchsorted(ends, start, side="right")
            counts = np.bincount(owner, minlength=len(texts))
            listed = pa.StructArray.from_arrays(
                [pa.array(start - begins[owner]), pa.array(length), pa.array(period)], fields=list(_RUN)
            )
            runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), listed)
            collapsed = [
                b" ".join([w for w, keep in zip(words, kept[a:b].tolist()) if keep] if count else words)
                for words, a, b, count in zip(texts, begins, ends, counts)
            ]
            rows = batch.column("__row").slice(done, len(texts))
            done += len(texts)
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(sizes), runs, pa.array(collapsed, pa.binary())],
                names=["__row", "n_words", "runs", "collapsed"],
            )


def collapse_runs(
    docs: DataFrame, columns: list[str], text: str = "text", least: int = LEAST,
    rewrite: Rewrite | None = None, key: str | None = None,
) -> DataFrame:
    """``columns`` of every row as struct ``__row``, the words, runs and collapsed text beside it.

    ``runs`` hold start, length and period in words, by start, then period. ``collapsed`` (UTF-8) keeps
    the words outside runs and the first period of each run, joined by single blanks. ``rewrite``
    changes a text's words before, given the row's ``key``.
    """
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in columns)).alias("__row"),
        F.col(text).cast("string").alias("__text"),
        *([F.col(key).alias("__key")] if key else []),
    )
    schema = f"__row {rows.schema['__row'].dataType.simpleString()}, {RESULT}"
    return rows.mapInArrow(lambda batches: _run_rows(batches, least, rewrite), schema)


def repeat_tail(words: list[bytes], crc: int) -> list[bytes]:
    """The words with a periodic tail where the checksum ends in 0: a planted run for one text in ten."""
    n, g = len(words), crc // 10
    if crc % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    cycle = words[first : first + period]
    return words[:first] + (cycle * (-(-(n - first) // len(cycle))))[: n - first]
