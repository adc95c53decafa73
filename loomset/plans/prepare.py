"""Prepare job: read, format, measure, filter, split, write."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from loomset.errors import SplitMismatchError
from loomset.functions.tokens import token_count
from loomset.operators import splitting
from loomset.operators.formatting import drop_long_rows, format_rows, measure_rows
from loomset.operators.gates import require_rows
from loomset.operators.identity import KEY, with_example_id
from loomset.params import DatasetParams
from loomset.sources import storage
from loomset.sources.reader import load_rows, load_splits, loading
from loomset.sources.writer import require_free_name, splits_finished, write_splits

# At most this many hashes of long rows (32 characters each) are broadcast.
BROADCAST_ROWS = 100_000


def prepare(
    spark: SparkSession,
    params: DatasetParams,
    force: bool = False,
    counter: Callable[[Column], Column] = token_count,
    reuse_counts: bool = False,
) -> DataFrame:
    """Load the dataset by name and write its splits.

    Finished splits are kept unless forced, or made with other parameters or another counter.
    """
    if splits_finished(spark, params.processed_dir, job_name(params, counter)) and not force:
        return load_splits(spark, params.processed_dir)
    rows = load_rows(spark, params.name_or_path, params.schema)
    return prepare_rows(rows, params, counter, reuse_counts)


def job_name(params: DatasetParams, counter: Callable[[Column], Column]) -> str:
    """What decides the content of the splits, besides the source's rows."""
    given = {k: v for k, v in asdict(params).items() if k not in ("processed_dir", "raw_dir")}
    name = f"{counter.__module__}.{getattr(counter, '__qualname__', type(counter).__name__)}"
    return json.dumps(given | {"counter": name}, sort_keys=True)


def prepare_rows(
    rows: DataFrame,
    params: DatasetParams,
    counter: Callable[[Column], Column] = token_count,
    reuse_counts: bool = False,
) -> DataFrame:
    """Write the splits of a table of instruction rows and return them as read back.

    Two passes over the rows. The first stores hash and length flag of each row, from which the
    gates and the split borders are computed; the second formats again, which is cheaper than
    storing the text twice, and writes. Keys made from the content need the rows stored in
    between; a key column saves that. How the second drops long rows depends on how many there
    are, see :func:`_kept_rows`.
    """
    spark = rows.sparkSession
    require_free_name(rows)
    own_hash = splitting.split_hash(params.seed)
    keys_dir, keyed_dir = storage.scratch(spark, "keys"), storage.scratch(spark, "keyed")
    try:
        with loading(params.name_or_path):
            keyed = with_example_id(rows, params.key, keyed_dir)
            formatted = format_rows(keyed, params.system_prompt, params.chat_template)
            measured = measure_rows(formatted, params.max_seq_length, counter)
            measured.select(own_hash.alias("hash"), "within_limit").write.parquet(keys_dir)
        keys = spark.read.parquet(keys_dir)

        total, kept = splitting.count_rows(keys, F.col("within_limit"))
        if params.key is not None:
            splitting.require_unique(keys)
        require_rows("in the dataset", total, params.min_examples)
        require_rows("after length filtering", kept, params.min_examples)
        sizes = splitting.SplitSizes.of(kept, params.val_split, params.test_split)
        borders = splitting.find_borders(keys.where("within_limit").select("hash"), sizes)

        final = _kept_rows(formatted, measured, keys, own_hash, total - kept, reuse_counts)
        if not params.keep_source:
            final = final.select(KEY, "text", "prompt", "target")
        written = Observation("written")
        split = splitting.assign_split(final, own_hash, borders).observe(
            written, *[F.count_if(F.col("split") == name).alias(name) for name in splitting.SPLITS]
        )
        write_splits(
            split,
            params.processed_dir,
            sizes.as_dict(),
            lambda found: _check_written(found, sizes.as_dict(), written.get),
            job_name(params, counter),
            params.file_format,
            params.compression,
        )
    finally:
        storage.remove(spark, keys_dir)
        storage.remove(spark, keyed_dir)
    return load_splits(spark, params.processed_dir)


def _kept_rows(
    formatted: DataFrame,
    measured: DataFrame,
    keys: DataFrame,
    own_hash: Column,
    dropped: int,
    reuse_counts: bool,
) -> DataFrame:
    """The rows within the limit, without counting tokens again where that can be avoided.

    Nothing to drop: no filter. Few rows to drop, by the first pass's own count: their hashes
    are broadcast. Otherwise the tokens are counted once more, or, with ``reuse_counts`` for a
    costly counter, the kept hashes are joined back for one shuffle of the rows.
    """
    if dropped == 0:
        return formatted
    if dropped > BROADCAST_ROWS and not reuse_counts:
        return drop_long_rows(measured)
    hashed = formatted.withColumn("_hash", own_hash)
    if dropped <= BROADCAST_ROWS:
        long = keys.where(~F.col("within_limit")).select(F.col("hash").alias("_hash"))
        return hashed.join(F.broadcast(long), "_hash", "left_anti").drop("_hash")
    passed = keys.where("within_limit").select(F.col("hash").alias("_hash"))
    return hashed.join(passed, "_hash", "left_semi").drop("_hash")


def _check_written(rows: DataFrame, planned: dict[str, int], observed: dict[str, int]) -> None:
    """Written rows must be the planned ones; a recount settles a count blurred by task retries."""
    if observed == planned:
        return
    counts = splitting.split_sizes(rows).collect()
    found = {name: 0 for name in planned} | {row["split"]: row["rows"] for row in counts}
    if found != planned:
        raise SplitMismatchError(
            f"Planned {planned} but wrote {found}: the source changed while it was read, or "
            f"{KEY} is not unique."
        )
