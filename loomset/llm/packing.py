"""Best-fit packing of tokenized documents by matching large items.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces of each length
decides a packing, so the plan is made from the length histogram (at most ``capacity`` rows) for
whole groups of equal bins at once: pieces over half the capacity open bins, largest first; those
over a third are matched to a partner, each with the largest that still fits, so a bin holds at
most two of them; smaller pieces go, longest first, into the fullest bin that has room. Then every
piece finds its place from its rank among pieces of its length.

Defined results: a null text is empty and still yields its end token; equal rows give equal pieces,
each placed once; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import stored
from loomset.llm.subwords import encoder, portions, vocabulary_path

CAPACITY = 2048
END = 0
#: Cells that the pieces of one length are numbered in, so that no length meets in one task.
CELLS = 256

PIECES = "key long, piece int, start long, length long, ids_crc32 long, ids array<int>"
_PIECES_ARROW = pa.schema(
    [("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    coder, end = encoder(path), np.array([END], "<u4").tobytes()
    for batch in batches:
        rows = []
        texts = zip(batch.column(0).to_pylist(), batch.column(1))
        for keys, words in portions((key, text.as_buffer().to_pybytes() if text.is_valid else b"") for key, text in texts):
            for key, coded in zip(keys, coder.coded(words)):
                ids = coded + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    own = np.frombuffer(part, "<u4").tolist() if with_ids else None
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part), own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _PIECES_ARROW)] if rows else [pa.array([], f.type) for f in _PIECES_ARROW],
            schema=_PIECES_ARROW,
        )


def tokenize_pieces(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = True, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, CRC-32 of the ids, and the ids."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")
    narrow = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return narrow.mapInArrow(lambda batches: _cut(batches, path, capacity, with_ids), PIECES)


class PackingPlan:
    """Bins of equal content as groups; per length, which ranks go where.

    ``runs[length]`` is a list of (first rank, first bin, pieces of this length per bin, offset).
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins = 0
        self.runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.placed: dict[int, int] = defaultdict(int)
        #: Open groups by room left: room -> list of (first bin, bins).
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def _reopen(self, room: int, first: int, bins: int) -> None:
        if room and bins:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((first, bins))

    def put(self, length: int, first: int, bins: int, each: int, room: int) -> None:
        """Place ``each`` pieces of a length in each of some equal bins with ``room`` left."""
        self.runs[length].append((self.placed[length], first, each, self.capacity - room))
        self.placed[length] += bins * each
        self._reopen(room - each * length, first, bins)

    def new_bins(self, length: int, bins: int) -> None:
        first, self.bins = self.bins, self.bins + bins
        self.put(length, first, bins, 1, self.capacity)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` open bins with exactly that room."""
        first, bins = self.open[room].pop()
        if bins > most:
            self.open[room].append((first + most, bins - most))
            bins = most
        if not self.open[room]:
            self.rooms.pop(bisect_left(self.rooms, room))
        return first, bins

    def best_fit(self, length: int, count: int) -> None:
        """Pieces of one length, each into the fullest bin with room for it, else into a new one."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                first, room = self.bins, self.capacity
                bins = max(1, count // (room // length))
                self.bins += bins
            else:
                room = self.rooms[at]
                first, bins = self.take(room, max(1, count // (room // length)))
            each = min(count, room // length)
            self.put(length, first, bins, each, room)
            count -= bins * each


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> PackingPlan:
    """Plan for so many pieces of each length."""
    plan, third = PackingPlan(capacity), capacity // 3
    large = {length: n for length, n in histogram.items() if length > third and n}
    left, lengths = dict(large), sorted(large)
    for length in sorted(large, reverse=True):
        # The longest ones open bins; each takes the longest partner that is still free and fits.
        while left[length]:
            at = bisect_left(lengths, capacity - length + 1) - 1
            while at >= 0 and (not left[lengths[at]] or (lengths[at] == length and left[length] < 2)):
                at -= 1
            if at < 0:
                plan.new_bins(length, left[length])
                left[length] = 0
                break
            partner = lengths[at]
            pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
            left[length] -= pairs
            left[partner] -= pairs
            first = plan.bins
            plan.bins += pairs
            if partner == length:
                plan.put(length, first, pairs, 2, capacity)
            else:
                plan.runs[length].append((plan.placed[length], first, 1, 0))
                plan.placed[length] += pairs
                plan.put(partner, first, pairs, 1, capacity - length)
    for length in sorted((n for n in histogram if n <= third), reverse=True):
        plan.best_fit(length, histogram[length])
    return plan


def _place(batches: Iterator[pa.RecordBatch], runs: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            own = runs[int(length[rows[0]])]
            run = own[np.searchsorted(own[:, 0], rank[rows], side="right") - 1]
            step, place = np.divmod(rank[rows] - run[:, 0], run[:, 2])
            sequence[rows] = run[:, 1] + step
            offset[rows] = run[:, 3] + place * length[rows]
        names = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
            names=[*names, "sequence_id", "offset"],
        )


def pack(pieces: DataFrame, capacity: int = CAPACITY, cells: int = CELLS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (columns key, piece, length, ...).

    ``pieces`` is read twice and must give the same rows each time. The driver gets at most
    ``capacity`` counts; the plan it sends out has a few runs per length.
    """
    cell = F.pmod(F.xxhash64("key", "piece"), F.lit(cells)).cast("int")
    rows = pieces.withColumn("cell", cell)
    counts = rows.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("cell")
    # At most capacity x cells rows, whatever the input.
    bases = stored(counts.withColumn("base", F.sum("n").over(before) - F.col("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    runs = {length: np.array(own, np.int64) for length, own in plan.runs.items()}
    inside = Window.partitionBy("length", "cell").orderBy("key", "piece", "start")
    ranked = (
        rows.withColumn("nr", F.row_number().over(inside) - 1)
        .join(bases.drop("n"), ["length", "cell"])
        .withColumn("rank", F.col("base") + F.col("nr"))
        .drop("base", "nr", "cell")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(lambda b: _place(b, runs), f"{schema}, sequence_id long, offset long")


def build_sequences(packed: DataFrame) -> DataFrame:
    """The sequences: ``sequence_id`` and its ids in order of their offsets (at most one capacity)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
