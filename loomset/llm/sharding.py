"""Sharding by fixed virtual slots and a stored, versioned map from slots to shards.

A record hashes into one of a fixed number of slots. Only slots are placed: the bytes of each slot
are added up, and slots go, heaviest first, to the lightest shard. The map is a small table with a
version. Rebalancing (:func:`edit_map`) reads the newest version and appends one in which few slots
have moved; records never need to be hashed again.

Defined results: a null text weighs ``overhead`` bytes; equal rows share a slot; rows with equal
keys and other texts do not; an empty table gives an empty table and a map whose slots weigh nothing.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.llm.common import text_bytes
from loomset.sources.storage import finished, names_in

SLOTS = 8192
_SLOT, _SIZE, _CRC, _ROW = "__vslot", "__bytes", "__crc", "__row"


def with_slot(docs: DataFrame, key: str = "doc_id", slots: int = SLOTS, overhead: int = 16) -> DataFrame:
    """Size, checksum and virtual slot of every record, beside the record's columns as a struct."""
    payload = text_bytes(F.col("text"))
    return docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias(_ROW),
        (F.length(payload) + overhead).cast("long").alias(_SIZE),
        F.crc32(payload).alias(_CRC),
    ).withColumn(
        _SLOT, F.pmod(F.xxhash64(F.col(_ROW)[key].cast("string"), _CRC), F.lit(slots)).cast("int")
    )


def slot_weights(rows: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """``(slots, 2)``: bytes and rows of each slot. At most ``slots`` rows come to the driver."""
    weights = np.zeros((slots, 2), np.int64)
    for slot, size, count in rows.groupBy(_SLOT).agg(F.sum(_SIZE), F.count("*")).collect():
        weights[slot] = size, count
    return weights


def place_slots(weights: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each slot: heaviest slot first, each to the shard with the fewest bytes."""
    placed = np.zeros(len(weights), np.int32)
    heap = [(0, shard) for shard in range(shards)]
    for slot in np.lexsort((np.arange(len(weights)), -weights)):
        total, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (total + int(weights[slot]), shard))
    return placed


def rebalance(placed: np.ndarray, weights: np.ndarray, shards: int) -> np.ndarray:
    """Edit a map for another number of shards, moving few slots.

    New shards are filled from the fullest ones; slots of shards that are gone move to the
    lightest. All other slots stay where they are.
    """
    placed = placed.copy()
    load = np.bincount(placed, weights, minlength=max(shards, placed.max() + 1)).astype(np.int64)
    for slot in np.flatnonzero(placed >= shards):
        target = int(np.argmin(load[:shards]))
        load[target] += weights[slot]
        placed[slot] = target
    old = int(np.unique(placed).max()) + 1
    mean = int(weights.sum()) / shards
    for new in range(old, shards):
        while load[new] < mean:
            donor = int(np.argmax(load[:shards]))
            own = np.flatnonzero((placed == donor) & (weights > 0))
            fits = own[weights[own] <= mean - load[new]]
            if donor == new or not len(fits):
                break
            slot = fits[np.argmax(weights[fits])]
            placed[slot] = new
            load[donor] -= weights[slot]
            load[new] += weights[slot]
    return placed


def write_map(
    spark: SparkSession, location: str, version: int, placed: np.ndarray, weights: np.ndarray
) -> None:
    """Append one version of the map: a row per slot with its shard, bytes, rows, and first place there.

    A version that is there is never replaced: whoever reads it may rely on it.
    """
    if version in versions(spark, location):
        raise FileExistsError(f"{location} has a version {version} already")
    first = np.zeros(len(placed), np.int64)
    order = np.argsort(placed, kind="stable")
    ends = np.cumsum(weights[order, 1])
    begin = np.r_[True, placed[order][1:] != placed[order][:-1]]
    base = (ends - weights[order, 1])[begin]
    first[order] = ends - weights[order, 1] - np.repeat(base, np.diff(np.r_[np.flatnonzero(begin), len(order)]))
    rows = [
        (slot, int(placed[slot]), int(weights[slot, 0]), int(weights[slot, 1]), int(first[slot]))
        for slot in range(len(placed))
    ]
    frame = spark.createDataFrame(rows, "vslot int, shard int, bytes long, rows long, first long")
    # A failed writing of this version left no _SUCCESS, so it is no version and is written over.
    frame.coalesce(1).write.mode("overwrite").parquet(f"{location}/version={version}")


def versions(spark: SparkSession, location: str) -> list[int]:
    """Numbers of the finished versions of a map, oldest first."""
    found = [name for name in names_in(spark, location) if name.startswith("version=")]
    return sorted(int(name[8:]) for name in found if finished(spark, f"{location}/{name}"))


def read_map(spark: SparkSession, location: str, version: int | None = None) -> DataFrame:
    """One version of the map, or the newest."""
    if version is None:
        version = versions(spark, location)[-1]
    return spark.read.parquet(f"{location}/version={version}").select("vslot", "shard", "bytes", "first")


def edit_map(spark: SparkSession, location: str, shards: int, rows: DataFrame | None = None) -> int:
    """Rebalance the newest map to ``shards`` shards and append it as the next version; its number.

    Slots that need not move keep their shard. Bytes and rows of the slots are the stored ones, or
    those of ``rows`` (of :func:`with_slot`), for a table that has grown since. Places within shards
    are numbered anew, as slots that leave or join a shard shift those behind them. Records are not
    read for it unless ``rows`` is given, and never hashed into other slots.
    """
    version = versions(spark, location)[-1]
    stored = spark.read.parquet(f"{location}/version={version}").orderBy("vslot").collect()
    placed = np.array([r["shard"] for r in stored], np.int32)
    weights = np.array([(r["bytes"], r["rows"]) for r in stored], np.int64)
    if rows is not None:
        weights = slot_weights(rows, len(placed))
    write_map(spark, location, version + 1, rebalance(placed, weights[:, 0], shards), weights)
    return version + 1


def assign(rows: DataFrame, shard_map: DataFrame, order: list[Column]) -> DataFrame:
    """Shard of every record and its place there, gapless from 0.

    A map has a row per slot, a fixed number, so it is broadcast. Places are numbered within a
    virtual slot and shifted by the rows of the shard's earlier slots; no shard is gathered in one
    task.
    """
    inside = Window.partitionBy(_SLOT).orderBy(*order)
    return rows.join(
        F.broadcast(shard_map.withColumnRenamed("vslot", _SLOT)), _SLOT
    ).withColumn("slot", F.col("first") + F.row_number().over(inside) - 1)


def shard(
    docs: DataFrame, location: str, shards: int = 40, slots: int = SLOTS, key: str = "doc_id"
) -> DataFrame:
    """Put records into ``shards`` shards of near equal bytes; version 1 of the map at ``location``.

    Returns the key, ``size``, ``text_crc32``, ``shard`` and ``slot`` (place in the shard).
    """
    rows = with_slot(docs, key, slots).withColumn(_ROW, F.struct(F.col(_ROW)[key].alias(key)))
    weights = slot_weights(rows, slots)
    write_map(docs.sparkSession, location, 1, place_slots(weights[:, 0], shards), weights)
    placed = assign(rows, read_map(docs.sparkSession, location, 1), [F.col(_ROW)[key], F.col(_CRC)])
    return placed.select(
        F.col(_ROW)[key].alias(key),
        F.col(_SIZE).alias("size"),
        F.col(_CRC).alias("text_crc32"),
        F.col("shard"),
        F.col("slot").cast("long").alias("slot"),
    )
