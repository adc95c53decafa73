"""Exact, seeded train/validation/test split without sorting the data.

Rows are ordered by the MD5 of seed and key. The first rows in that order are the test split,
the next ones validation, the rest train. Only the two hashes at the borders are needed: they
are found by counting rows per hash prefix, and every row is then placed by comparing its hash
with two literals, so wide rows are not shuffled and membership depends on nothing but seed
and keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.errors import ConfigError, DuplicateKeyError
from loomset.operators.identity import KEY
from loomset.sources.storage import remove, scratch
from loomset.sources.writer import SPLITS

# Hash digits counted per step: at most 4,096 counts reach the driver per border.
PREFIX_DIGITS = 3
# A prefix with at most this many rows is fetched; a larger one is counted further.
FETCH_ROWS = 4096
HASH_DIGITS = 32


@dataclass(frozen=True)
class SplitSizes:
    train: int
    validation: int
    test: int

    @classmethod
    def of(cls, rows: int, validation: float, test: float) -> SplitSizes:
        """Both held-out shares are rounded up; train gets the remainder."""
        share = round(validation + test, 9)
        held = min(rows, math.ceil(round(share * rows, 9)))
        in_test = math.ceil(round(test / share * held, 9)) if share else 0
        return cls(rows - held, held - in_test, in_test)

    def as_dict(self) -> dict[str, int]:
        return {name: getattr(self, name) for name in SPLITS}


@dataclass(frozen=True)
class SplitBorders:
    """Hash of the last test row and of the last held-out row; None where there is no such row."""

    test: str | None
    held: str | None


def split_hash(seed: int, key: Column | None = None) -> Column:
    key = F.col(KEY) if key is None else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def count_rows(hashes: DataFrame, kept: Column | None = None) -> tuple[int, int]:
    """All rows and those ``kept``, in one pass that also refuses rows without a key."""
    row = hashes.agg(
        F.count("*").alias("rows"),
        F.count_if(F.lit(True) if kept is None else kept).alias("kept"),
        F.count_if(F.col("hash").isNull()).alias("keyless"),
    ).first()
    if row["keyless"]:
        raise ConfigError(f"{row['keyless']} rows have a null {KEY}; every row needs a key.")
    return row["rows"], row["kept"]


def require_unique(hashes: DataFrame) -> None:
    """Refuse rows that share a key. Equal hashes meet within a task first; 16 bytes are shuffled."""
    shared = hashes.groupBy(F.unhex("hash").alias("hash")).count().where("count > 1").take(1)
    if shared:
        raise DuplicateKeyError(f"{shared[0]['count']} rows share one {KEY}; keys must be unique.")


def find_borders(hashes: DataFrame, sizes: SplitSizes) -> SplitBorders:
    """The border hashes of a table with one ``hash`` per kept row.

    The table is read a few times (twice for up to sixteen million rows, once more for every
    factor of 4,096), so hand in a stored or cheap one.
    """
    total = sum(sizes.as_dict().values())
    last_test, last_held = sizes.test, sizes.test + sizes.validation
    found = _hashes_at(hashes, {rank for rank in (last_test, last_held) if rank}, total)
    return SplitBorders(found.get(last_test), found.get(last_held))


def assign_split(rows: DataFrame, hash_value: Column, borders: SplitBorders) -> DataFrame:
    """Add ``split`` by comparing each row's hash with the borders: a projection, no shuffle."""
    name = F.lit("train")
    if borders.held is not None:
        name = F.when(hash_value <= F.lit(borders.held), F.lit("validation")).otherwise(name)
    if borders.test is not None:
        name = F.when(hash_value <= F.lit(borders.test), F.lit("test")).otherwise(name)
    return rows.withColumn("split", name)


def split_rows(rows: DataFrame, validation: float, test: float, seed: int) -> DataFrame:
    """Split a keyed table. Its hashes are stored for the search, so that it is computed once
    for them and once for the result."""
    spark = rows.sparkSession
    directory = scratch(spark, "hashes")
    try:
        rows.select(split_hash(seed).alias("hash")).write.parquet(directory)
        hashes = spark.read.parquet(directory)
        total, _ = count_rows(hashes)
        require_unique(hashes)
        borders = find_borders(hashes, SplitSizes.of(total, validation, test))
    finally:
        remove(spark, directory)
    return assign_split(rows, split_hash(seed), borders)


def split_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("rows"))


@dataclass
class _Place:
    """A prefix that holds the wanted row, which is number ``rank`` of the prefix's rows."""

    prefix: str
    rank: int
    rows: int


def _below(places: list[_Place]) -> Column:
    """Rows of any of the prefixes."""
    tests = [F.col("hash").startswith(prefix) for prefix in sorted({p.prefix for p in places})]
    return reduce(lambda a, b: a | b, tests)


def _hashes_at(hashes: DataFrame, ranks: set[int], total: int) -> dict[int, str]:
    places = {rank: _Place("", rank, total) for rank in ranks}
    digits = 0
    while large := [place for place in places.values() if place.rows > FETCH_ROWS]:
        if digits >= HASH_DIGITS:
            raise DuplicateKeyError(f"{large[0].rows} rows share one {KEY}; keys must be unique.")
        digits += PREFIX_DIGITS
        counted = (
            hashes.where(_below(large))
            .groupBy(F.substring("hash", 1, digits).alias("prefix"))
            .count()
            .collect()
        )
        counts = sorted((row["prefix"], row["count"]) for row in counted)
        for place in large:
            _descend(place, [(p, n) for p, n in counts if p.startswith(place.prefix)])
    if not places:
        return {}
    fetched = sorted(row["hash"] for row in hashes.where(_below([*places.values()])).collect())
    return {rank: _pick(place, fetched) for rank, place in places.items()}


def _descend(place: _Place, counts: list[tuple[str, int]]) -> None:
    """Move into the longer prefix that holds the rank."""
    for prefix, rows in counts:
        if place.rank <= rows:
            place.prefix, place.rows = prefix, rows
            return
        place.rank -= rows


def _pick(place: _Place, fetched: list[str]) -> str:
    inside = [value for value in fetched if value.startswith(place.prefix)]
    chosen = inside[place.rank - 1]
    if place.rank < len(inside) and inside[place.rank] == chosen:
        raise DuplicateKeyError(f"Two rows at a split border share one {KEY}; keys must be unique.")
    return chosen
