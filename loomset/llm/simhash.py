"""SimHash near-duplicates by tiled, exact comparison.

Fingerprints are compared with exclusive-or and bit counts in numpy. Distinct fingerprints are
tiled by the population counts of their four 16-bit quarters. The distance of two fingerprints is
at least the sum of the differences of these counts, so a pair of tiles beyond the radius is never
met; inside a pair of tiles the counts of the eight bytes rule out blocks in the same way. Nothing
else is skipped, so no link is lost. A tile with more than ``CHUNK`` fingerprints, or more that come to be
compared with it, is dealt into chunks by hash, and every pair of chunks is a piece of work of its own.

A task keeps of the links it finds a spanning forest only, enough for the components and never
more than one link per fingerprint that it has seen. Components are then found by hooking and
pointer jumping over links between fingerprints, with every round written to shared storage.

Defined results: a null or wordless text has fingerprint zero, linked like any other; equal rows
share a component; null keys are kept and belong to the component of their fingerprint; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import keep_one, never_null, stored, whole_row

SHINGLE = 3
RADIUS = 3
SEED = 42
_QUARTERS, _BYTES = 4, 8
#: Rows of a tile that are compared at once: 2 MB of distances per step.
BLOCK = 512
#: Fingerprints of one side that a piece of work compares at most, but for the chance of the hash.
CHUNK = 1 << 17
_CHUNK_BITS = 21


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text in UTF-8: bit set if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], "<u8")
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [
            _signed(fingerprint(t.as_buffer().to_pybytes(), shingle, seed) if t.is_valid else 0)
            for t in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["key", "print"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, print)``: fingerprints as signed 64-bit numbers."""
    narrow = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return narrow.mapInArrow(lambda b: _fingerprints(b, shingle, seed), "key long, print long")


def _counts(prints: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of equal parts of each fingerprint."""
    width = {4: np.uint16, 8: np.uint8}[parts]
    return np.bitwise_count(prints.view(width).reshape(-1, parts)).astype(np.int8)


def _tile(counts: np.ndarray) -> np.ndarray:
    """Number of a tile: the four counts (0 to 16) in base 32."""
    return counts.astype(np.int64) @ (32 ** np.arange(_QUARTERS, dtype=np.int64))


def _steps(radius: int) -> np.ndarray:
    """Differences of tile counts within the radius, one of each opposite pair, none included."""
    axis = np.arange(-radius, radius + 1)
    every = np.stack(np.meshgrid(*[axis] * _QUARTERS, indexing="ij"), -1).reshape(-1, _QUARTERS)
    near = every[np.abs(every).sum(1) <= radius]
    return near[len(near) // 2 :]  # lexicographic order is symmetric about the zero step


def _occupied_tiles(prints: DataFrame, radius: int, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Tiles that have hosts, sorted, and into how many chunks the hosts and the guests of each go.

    Counts per tile reach the driver: there are 17^4 tiles at most, however many fingerprints.
    """
    quarters = [F.bit_count(F.shiftrightunsigned("print", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(_QUARTERS)]
    named = [q.alias(f"q{k}") for k, q in enumerate(quarters)]
    hosts = np.zeros([17 + 2 * radius] * _QUARTERS, np.int64)
    for *place, n in prints.groupBy(*named).agg(F.count("*")).collect():
        hosts[tuple(radius + c for c in place)] = n
    guests = np.zeros_like(hosts)
    for step in _steps(radius)[1:]:
        # The margin as wide as the radius is empty, so nothing comes round at the other end.
        guests += np.roll(hosts, step, axis=tuple(range(_QUARTERS)))
    place = np.nonzero(hosts)
    tiles = _tile(np.stack(place, 1) - radius)
    chunks = np.maximum(1, -(-np.stack([hosts[place], guests[place]], 1) // chunk)).astype(np.int32)
    order = np.argsort(tiles)
    return tiles[order], chunks[order]


def _spread(repeats: np.ndarray, bound: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions repeated so many times, with the number of the repeat, in bounded pieces."""
    ends = np.cumsum(repeats)
    for at in range(0, int(ends[-1]) if len(ends) else 0, bound):
        every = np.arange(at, min(at + bound, int(ends[-1])))
        row = np.searchsorted(ends, every, side="right")
        yield row, every - (ends - repeats)[row]


def _cell(tile: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Number of a piece of work: hosts of the first chunk, and what the second holds."""
    return (tile << 2 * _CHUNK_BITS) | (first << _CHUNK_BITS) | second


def _to_tiles(
    batches: Iterator[pa.RecordBatch], radius: int, occupied: np.ndarray, chunks: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Each fingerprint as host in its own tile and as guest in the tiles it must be compared with.

    Tiles without a host get no guests. A tile with h chunks of hosts and g of guests has the cells (i, i), hosts among themselves and
    with the first chunk of guests; (i, j) for i < j < h, hosts with hosts; and (i, h + q), hosts
    with a later chunk of guests.
    """
    steps = _steps(radius)[1:]

    def place(tile: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(occupied, tile), len(occupied) - 1)

    def rows(cell: np.ndarray, prints: np.ndarray, host: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(prints.view(np.int64)), pa.array(host)], names=["cell", "print", "host"]
        )

    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        for at in range(0, len(prints), 4096):
            part = prints[at : at + 4096]
            dealt = ((part * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)
            counts = _counts(part, _QUARTERS)
            tile = _tile(counts)
            h, g = chunks[place(tile)].T.astype(np.int64)
            for row, k in _spread(h + g - 1):
                own, later = dealt[row] % h[row], k >= h[row]
                other = k + later  # a later chunk of guests is h + 1 on
                yield rows(_cell(tile[row], np.minimum(own, other), np.maximum(own, other)), part[row], other >= own)
            goals = counts[:, None, :] + steps[None].astype(np.int8)
            guest, step = np.nonzero(((goals >= 0) & (goals <= 16)).all(-1))
            tile = _tile(goals[guest, step])
            at_home = occupied[place(tile)] == tile
            guest, tile = guest[at_home], tile[at_home]
            h, g = chunks[place(tile)].T.astype(np.int64)
            for row, k in _spread(h):
                own = dealt[guest[row]] % g[row]
                yield rows(_cell(tile[row], k, np.where(own == 0, k, h[row] + own)), part[guest[row]], np.zeros(len(row), bool))


class Forest:
    """Trees over positions by label; keeps the links that joined two trees."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Take in many links at once: one of each pair of trees is looked at, in numpy but for those."""
        a, b = self.label[left], self.label[right]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        _, first = np.unique(low * len(self.label) + high, return_index=True)
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while (up := parent.get(node, node)) != node:
                parent[node] = parent.get(up, up)
                node = up
            return node

        for at in first.tolist():
            x, y = root(int(low[at])), root(int(high[at]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                link = apart[at]
                self.links.append((int(left[link]), int(right[link])))
        new = np.arange(len(self.label))
        for node in list(parent):
            new[node] = root(node)
        self.label = new[self.label]


def compare_tiles(hosts: np.ndarray, guests: np.ndarray, radius: int = RADIUS, block: int = BLOCK, among: bool = True) -> list[tuple[int, int]]:
    """A spanning forest of the links ``among`` hosts and between hosts and guests.

    Both sides are sorted by the counts of their bytes, cut into blocks, and a pair of blocks whose
    ranges of counts are further apart than the radius is skipped.
    """
    hosts = hosts[np.lexsort(_counts(hosts, _BYTES).T)]
    guests = guests[np.lexsort(_counts(guests, _BYTES).T)] if len(guests) else guests
    every = np.concatenate([hosts, guests])
    forest = Forest(len(every))
    bounds = []
    for side, size in ((0, len(hosts)), (len(hosts), len(guests))):
        for at in range(side, side + size, block):
            counts = _counts(every[at : min(at + block, side + size)], _BYTES).astype(np.int16)
            bounds.append((at, min(at + block, side + size), counts.min(0), counts.max(0)))
    low = np.array([b[2] for b in bounds])
    high = np.array([b[3] for b in bounds])
    for own, (a0, a1, least, most) in enumerate(bounds):
        if a0 >= len(hosts):
            break
        apart = np.maximum(0, np.maximum(low - most, least - high)).sum(1)
        for other in np.flatnonzero(apart <= radius):
            b0, b1 = bounds[other][:2]
            if other < own or not (among or b0 >= len(hosts)):
                continue
            near = np.bitwise_count(every[a0:a1, None] ^ every[None, b0:b1]) <= radius
            left, right = np.nonzero(near)
            forest.join(left + a0, right + b0)
    signed = every.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in forest.links]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell: one cell's hosts and guests at a time, across batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    mask = (1 << _CHUNK_BITS) - 1

    def links(cell: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        prints = np.concatenate([p for p, _ in parts]).view(np.uint64)
        host = np.concatenate([h for _, h in parts])
        among = cell >> _CHUNK_BITS & mask == cell & mask
        found = compare_tiles(prints[host], prints[~host], radius, among=among) if host.any() else []
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], schema=schema)

    held, cell = [], None
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        prints = batch.column("print").to_numpy()
        host = batch.column("host").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and cells[a] != cell:
                yield links(cell, held)
                held = []
            cell = int(cells[a])
            held.append((prints[a:b], host[a:b]))
    if held:
        yield links(cell, held)


def link_forest(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all within the radius.

    ``prints`` is read twice: for the sizes of the tiles, then to be dealt into them.
    """
    occupied, chunks = _occupied_tiles(prints, radius, chunk)
    tiled = prints.mapInArrow(lambda b: _to_tiles(b, radius, occupied, chunks), "cell long, print long, host boolean")
    dealt = tiled.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(lambda b: _compare(b, radius), "a long, b long")


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``(node, root)`` for every node with a link; the root is the smallest node it reaches.

    Each round gives every link's ends the smaller root nearby, points roots at smaller ones and
    replaces links by links between roots, so links shrink and long chains halve. Stored each round.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label
    )
    while True:
        # Every node's smallest neighbour (or itself): all its larger and other neighbours hook there.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(best, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Then among smaller neighbours only: all of them, and the node, hook to the smallest.
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = stored(small.where("u <> v").distinct(), label)
        changed = after.exceptAll(edges).limit(1).count() + edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(print, root, component_id)`` of every distinct fingerprint of ``rows`` (key, print)."""
    classes = stored(rows.groupBy("print").agg(F.min("key").alias("first")), "fingerprint-classes")
    roots = components(link_forest(classes.select("print"), radius))
    grouped = classes.join(roots, classes["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    return grouped.join(named, "root").select("print", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest key it reaches)."""
    rows = stored(fingerprints(docs, shingle, SEED, key, text), "fingerprints")
    return rows.join(fingerprint_classes(rows, radius), "print").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _with_print(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "__text"]
        prints = [
            _signed(fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0) for t in batch.column("__text")
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(prints, pa.int64())], names=[*names, "__print"]
        )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest key.

    Which key and fingerprint stay is found on narrow rows, per component by a partial aggregate;
    components are never gathered. Null keys come last.
    """
    rows = stored(fingerprints(docs, shingle, SEED, key, text), "fingerprints")
    order = F.struct(F.col("key").isNull().alias("missing"), F.col("key"), F.col("print"))
    stays = rows.join(fingerprint_classes(rows, radius), "print").groupBy("root").agg(F.min(order).alias("first"))
    stays = stays.select(*never_null(F.col("first.key")), F.col("first.print").alias("__print"))
    narrow = docs.select(whole_row(docs).alias("__row"), *never_null(F.col(key)), F.col(text).cast("string").alias("__text"))
    schema = narrow.drop("__text").schema.add("__print", "long")
    printed = narrow.mapInArrow(lambda b: _with_print(b, shingle), schema)
    return keep_one(printed, stays, ["__null", "__key", "__print"])
