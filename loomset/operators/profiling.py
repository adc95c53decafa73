"""A first look at a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.functions.text import fused_word_count
from loomset.operators.identity import KEY

# Fixed value: the exploration looks at this many rows.
SAMPLE_ROWS = 500


def word_lengths(rows: DataFrame) -> DataFrame:
    """``(example_id, n_words)`` over instruction, context and response joined without a gap."""
    fields = [F.col(name) for name in ("instruction", "context", "response")]
    return rows.select(KEY, fused_word_count(*fields).alias("n_words"))


def length_profile(rows: DataFrame, sample: int | None = SAMPLE_ROWS) -> DataFrame:
    """Row count, mean, 95th percentile (linear interpolation) and maximum of the word lengths.

    ``sample`` rows by key are looked at; None means all. Rows are first counted per length, so
    the exact percentile works on the distinct lengths instead of on the rows.
    """
    if sample is not None:
        rows = rows.orderBy(KEY).limit(sample)
    lengths = word_lengths(rows).groupBy("n_words").agg(F.count("*").alias("n"))
    return lengths.agg(
        F.sum("n").alias("n_rows"),
        (F.sum(F.col("n_words") * F.col("n")) / F.sum("n")).alias("mean_words"),
        F.percentile("n_words", 0.95, F.col("n")).alias("p95_words"),
        F.max("n_words").alias("max_words"),
    )


def preview(formatted: DataFrame) -> DataFrame:
    """Prompt and full text of the first row by key."""
    return formatted.select(KEY, "prompt", "text").orderBy(KEY).limit(1)
