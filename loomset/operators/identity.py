"""Row keys. Everything that pairs rows up later relies on a unique ``example_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from loomset.sources.storage import scratch

KEY = "example_id"
# The filter of repeated contents is broadcast: at most so many rows of two longs.
MOST_WORDS = 1 << 20
# Repeated contents per word of the filter, until it has its most words.
LOAD = 4
# Copies of one content are written out in runs of so many, or of as many as make this many runs.
RUN = 1_000
MOST_RUNS = 4_096
# Nested values are told apart by all they hold: null fields, and times to the microsecond.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def content_key(rows: DataFrame) -> Column:
    """SHA-256 over all columns. Lengths are written too, so values cannot run into each other."""

    def written(field) -> Column:
        column = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, (ArrayType, MapType, StructType))
        text = F.to_json(column, _JSON) if nested else column.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[written(field) for field in rows.schema]), 256)


def with_example_id(
    rows: DataFrame, key: str | None = None, directory: str | None = None
) -> DataFrame:
    """Add ``example_id``: the caller's key column, else a key derived from the content."""
    if key is not None:
        return rows if key == KEY else rows.withColumn(KEY, F.col(key))
    return with_content_id(rows, directory or scratch(rows.sparkSession, "keyed"))


def with_content_id(rows: DataFrame, directory: str) -> DataFrame:
    """Key each row by its content and number the copies of one row 0, 1, 2, ...

    Copies are alike in every column, so which copy gets which number does not show, and the
    keyed table is the same however the input is laid out. The rows are stored once below
    ``directory``. A Bloom filter of the contents that occur more than once is broadcast; a row
    that it rules out is number 0 and its text goes through no exchange. The others are counted
    with one row of each content, which combines copies within a task before the exchange, and
    written out again from that row. A row that the filter lets pass without need is counted once
    and comes out as it is. Beyond ``LOAD * MOST_WORDS`` repeated contents the filter rules out
    fewer rows, and more of them are exchanged.

    Defined results: an empty table stays empty; null differs from the empty text.
    """
    stored = _kept(rows.withColumn("__content", content_key(rows)), f"{directory}/rows")
    seen = Observation()
    counting = _repeated(stored).observe(seen, F.count("*").alias("n"))
    repeated = _kept(counting, f"{directory}/repeated")
    names = [f"`{name}`" for name in rows.columns]
    n = seen.get.get("n", 0)  # nothing is observed where nothing is repeated
    if n == 0:
        return _numbered(stored.withColumn("__number", F.lit(0)), names)
    n_words = min(MOST_WORDS, 1 << (n // LOAD).bit_length())
    words = _kept(bloom_filter(repeated, n_words), f"{directory}/filter")
    checked = with_may_repeat(stored, words, n_words)
    counted = _kept(_counted(checked.where("__may_repeat"), names), f"{directory}/counted")
    single = checked.where("not __may_repeat").withColumn("__number", F.lit(0))
    return _numbered(single, names).unionByName(_numbered(_written_out(counted), names))


def _kept(rows: DataFrame, location: str) -> DataFrame:
    rows.write.parquet(location)
    return rows.sparkSession.read.schema(rows.schema).parquet(location)


def _numbered(rows: DataFrame, names: list[str]) -> DataFrame:
    made = F.concat("__content", F.lit("-"), F.col("__number").cast("string"))
    return rows.select(*names, made.alias("__key")).withColumn(KEY, F.col("__key")).drop("__key")


def _repeated(stored: DataFrame) -> DataFrame:
    """Hashes of the contents that occur more than once."""
    counts = stored.groupBy("__content").agg(F.count("*").alias("_n"))
    return counts.where("_n > 1").select(F.xxhash64("__content").alias("__hash"))


def _word(n_words: int) -> Column:
    return F.col("__hash").bitwiseAND(F.lit(n_words - 1).cast("long"))


def _bits() -> Column:
    """Four bits of a word, chosen by the upper half of the hash, which chooses no word."""
    one = "shiftleft(1L, cast(shiftrightunsigned(__hash, {}) & 63 as int))"
    return F.expr(" | ".join(one.format(at) for at in (40, 46, 52, 58)))


def bloom_filter(hashes: DataFrame, n_words: int) -> DataFrame:
    """``(__word, __set)``: a Bloom filter of ``__hash`` in ``n_words`` (a power of two) words of 64 bits.

    All four bits of a hash lie in one word, so that a row asks for one word.
    """
    return hashes.groupBy(_word(n_words).alias("__word")).agg(F.bit_or(_bits()).alias("__set"))


def with_may_repeat(stored: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """Add ``__may_repeat``: false only for contents that are not in the filter."""
    hashed = stored.withColumn("__hash", F.xxhash64("__content")).withColumn("__word", _word(n_words))
    there = F.col("__set").bitwiseAND(_bits()) == _bits()
    return (
        hashed.join(F.broadcast(words), "__word", "left")  # at most MOST_WORDS rows
        .withColumn("__may_repeat", F.coalesce(there, F.lit(False)))
        .drop("__word", "__hash", "__set")
    )


def _counted(rows: DataFrame, names: list[str]) -> DataFrame:
    """``(__content, _row, _n)``: one row of each content and how often it occurs."""
    one = F.first(F.struct(*names)).alias("_row")
    return rows.groupBy("__content").agg(one, F.count("*").alias("_n"))


def _written_out(counted: DataFrame) -> DataFrame:
    """Every copy with its number. Runs are dealt to tasks, so that no task writes out a hot row alone."""
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.greatest(F.lit(RUN), F.ceil(F.col("_n") / MOST_RUNS)).cast("long")
    runs = counted.withColumn("_size", size).withColumn(
        "_first", F.explode(F.expr("sequence(0L, _n - 1, _size)"))
    )
    copies = runs.repartition(tasks, "__content", "_first").withColumn(
        "__number", F.explode(F.expr("sequence(_first, least(_first + _size, _n) - 1)"))
    )
    return copies.select("__content", "__number", "_row.*")
