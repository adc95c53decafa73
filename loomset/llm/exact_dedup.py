"""Exact deduplication by Grace hashing.

Each task partitions its records by content hash into spill files, recursively, until a bucket fits
an open-addressing table; the table compares complete contents, so equal hashes of different texts
cannot merge. It runs twice. First over the input's own partitions, where it leaves one
representative per text and partition: a group of copies, however large, then has at most one row
per partition. Only representatives are shuffled, by digest, and go through the second pass. A
narrow join carries the verdict back to all rows; its key is a representative, which stands for no
more rows than one input partition has.

Spill files lie in the task's own temporary folder, as Spark's shuffle spills do, and are gone when
the task ends.

Defined results: null counts as empty; the row with the largest key stays, null keys being
smallest; of rows with equal key and text one stays; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import keep_one, never_null, stored, text_bytes, whole_row

#: Bytes that a bucket's table may hold at once: contents, and what Python needs for an entry of the
#: table and for a tag.
TABLE_BYTES = 64 << 20
ENTRY_BYTES, TAG_BYTES = 250, 120
#: Spill files per level of the recursion.
FAN_OUT = 16
MAX_LEVEL = 12

Record = tuple[bytes, int, object]


class ContentTable:
    """Open addressing with linear probing; a slot points at a content, which is compared whole."""

    def __init__(self, capacity: int = 1024):
        self.slots = np.full(capacity, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find_or_add(self, content: bytes, digest: int) -> int:
        mask = len(self.slots) - 1
        at = digest & mask
        while (index := self.slots[at]) >= 0:
            if self.hashes[index] == digest and self.contents[index] == content:
                return int(index)
            at = (at + 1) & mask
        index = self.slots[at] = len(self.contents)
        self.hashes.append(digest)
        self.contents.append(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return int(index)

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for index, digest in enumerate(self.hashes):
            at = digest & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = index


def _hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little") >> 1


def _bucket(digest: int, level: int) -> int:
    """The recursion's levels read different bits; the table's probes read the lowest ones."""
    return (digest >> (59 - 4 * level)) % FAN_OUT


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace_groups(
    records: Iterable[tuple[bytes, object]], table_bytes: int = TABLE_BYTES
) -> Iterator[tuple[bytes, list[object]]]:
    """``(content, tags)`` of each distinct content. ``records`` are (content, tag) pairs.

    Distinct contents and all tags are held up to ``table_bytes``; once they exceed that, what the
    table holds and all records still to come go to spill files by hash, and each file is treated
    alike. The tags of one content must fit in memory: they are the keys of one input partition, or
    one tag per input partition.
    """
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        hashed = ((content, _hash(content), [tag]) for content, tag in records)
        yield from _groups(hashed, 0, folder, table_bytes)


def _groups(
    records: Iterator[tuple[bytes, int, list]], level: int, folder: str, table_bytes: int
) -> Iterator[tuple[bytes, list]]:
    held, table, tags = 0, ContentTable(), []
    for content, digest, more in records:
        index = table.find_or_add(content, digest)
        held += TAG_BYTES * len(more)
        if index < len(tags):
            tags[index].extend(more)
        else:
            tags.append(list(more))
            held += ENTRY_BYTES + len(content)
        if held > table_bytes and len(tags) > 1 and level < MAX_LEVEL:
            break
    else:
        yield from zip(table.contents, tags)
        return
    paths = [os.path.join(folder, f"{level}-{part}") for part in range(FAN_OUT)]
    files = [open(path, "wb") for path in paths]
    try:
        for record in zip(table.contents, table.hashes, tags):
            pickle.dump(record, files[_bucket(record[1], level)], pickle.HIGHEST_PROTOCOL)
        del table, tags
        for record in records:
            pickle.dump(record, files[_bucket(record[1], level)], pickle.HIGHEST_PROTOCOL)
    finally:
        for file in files:
            file.close()
    for path in paths:
        inner = tempfile.mkdtemp(dir=folder)
        yield from _groups(_read(path), level + 1, inner, table_bytes)
        os.remove(path)


def _local(batches: Iterator[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of one input partition: all with their representative, which alone keeps its text."""
    base = TaskContext.get().partitionId() << 33

    def records() -> Iterator[tuple[bytes, object]]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield text.as_buffer().to_pybytes() if text.is_valid else b"", key

    out, size, number = [], 0, 0
    for content, keys in grace_groups(records(), table_bytes):
        number += 1
        ranked = sorted(keys, key=lambda k: (k is not None, k if k is not None else 0), reverse=True)
        digest = hashlib.sha256(content).hexdigest()
        for place, key in enumerate(ranked):
            first = place == 0
            out.append((key, base + number, len(keys) if first else 0, digest, content if first else None))
        size += len(content) + 100 * len(keys)
        if size > 4 << 20:
            yield _batch(out, LOCAL)
            out, size = [], 0
    if out:
        yield _batch(out, LOCAL)


LOCAL = "key long, rep long, copies long, text_sha256 string, content binary"
_LOCAL_ARROW = pa.schema(
    [("key", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("text_sha256", pa.string()), ("content", pa.binary())]
)
VERDICT = "rep long, keep_rep long, keep_id long, group_size long"
_VERDICT_ARROW = pa.schema([(n, pa.int64()) for n in ("rep", "keep_rep", "keep_id", "group_size")])


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    schema = _LOCAL_ARROW if kind is LOCAL else _VERDICT_ARROW
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _merge(batches: Iterator[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """Representatives of one digest range: which one of each text stays, and all its copies."""

    def records() -> Iterator[tuple[bytes, object]]:
        for batch in batches:
            tags = zip(*(batch.column(c).to_pylist() for c in ("key", "rep", "copies")))
            for content, tag in zip(batch.column("content"), tags):
                yield content.as_py(), tag

    out = []
    for _, tags in grace_groups(records(), table_bytes):
        key, rep, _ = max(tags, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        total = sum(copies for _, _, copies in tags)
        out.extend((r, rep, key, total) for _, r, _ in tags)
        if len(out) > 50_000:
            yield _batch(out, VERDICT)
            out = []
    if out:
        yield _batch(out, VERDICT)


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    local = stored(narrow.mapInArrow(lambda b: _local(b, table_bytes), LOCAL), "copies")
    rows = local.drop("content")
    reps = local.where("copies > 0").select("key", "rep", "copies", "text_sha256", "content")
    verdict = reps.repartition("text_sha256").mapInArrow(lambda b: _merge(b, table_bytes), VERDICT)
    stays = (F.col("copies") > 0) & (F.col("rep") == F.col("keep_rep"))
    return rows.join(verdict, "rep").select(
        F.col("key").alias(key), "keep_id", "group_size", stays.alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows with equal key and text differ in other columns at most; the largest one of them stays.
    """
    stays = find_copies(docs, key, text).where("kept").select(*never_null(F.col(key)), F.col("text_sha256").alias("__sha"))
    digest = F.sha2(text_bytes(F.col(text)), 256)
    rows = docs.select(whole_row(docs).alias("__row"), *never_null(F.col(key)), digest.alias("__sha"))
    return keep_one(rows, stays, ["__null", "__key", "__sha"])
