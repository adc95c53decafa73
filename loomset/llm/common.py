"""What the operators share: tables, words, checksum folds and stored intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.sources.storage import scratch

# A word is a run of code points that are no ASCII white space. bytes.split()
# without an argument splits UTF-8 at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write rows below the shared checkpoint folder and read them back.

    Cuts the lineage: later passes do not compute the rows again, and a lost executor costs a
    re-read only.
    """
    where = scratch(rows.sparkSession, label)
    rows.write.parquet(where)
    return rows.sparkSession.read.schema(rows.schema).parquet(where)


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``: the contract's train/held-out rule."""
    return F.crc32(text_bytes(key.cast("string"))) % modulus


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8."""
    return (text or "").encode("utf-8", "replace").split()


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that none can clash with an operator's own."""
    return F.struct(*(docs[f"`{c}`"] for c in docs.columns))


def keep_one(rows: DataFrame, stays: DataFrame, on: list[str]) -> DataFrame:
    """Unpack ``__row`` of one row (the largest) for each combination of ``on`` that ``stays`` has.

    Equal combinations meet within a task before they are shuffled; the semi-join then finds the
    rows where the aggregate left them. Columns of ``on`` must not be null.
    """
    one = rows.groupBy(*on).agg(F.max("__row").alias("__row"))
    return one.join(stays.select(*on).distinct(), on, "left_semi").select("__row.*")


def never_null(key: Column) -> list[Column]:
    """A long key as two columns without nulls: ``__null`` and ``__key``."""
    long = key.cast("long")
    return [long.isNull().alias("__null"), F.coalesce(long, F.lit(0)).alias("__key")]


def labelled_texts(docs: DataFrame, labels: DataFrame, where: Column, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """``(label, draw, text)`` of at most ``rows`` distinct texts that may be learned from, drawn by hash.

    ``docs`` has the key and ``text``; ``labels`` the key and a column ``label`` of 0 and 1, nulls being
    no labels. The lowest label of a text counts. Labels meet keys and text hashes only; the drawn
    texts, at most ``rows``, are picked out by a broadcast of their hashes.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.min(label).cast("int").alias("label")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    wanted = docs.where(where).select(F.col(key).alias("__key"), F.xxhash64(text).alias("draw"), text.alias("text"))
    drawn = (
        wanted.select("__key", "draw").join(known, "__key").groupBy("draw")
        .agg(F.min("label").alias("label"), F.min("__key").alias("__key"))
        .orderBy("draw").limit(rows)
    )
    found = wanted.join(F.broadcast(drawn), ["__key", "draw"])
    return found.groupBy("draw").agg(F.first("label").alias("label"), F.first("text").alias("text")).select("label", "draw", "text")
