"""Prepare rows as their files arrive: format, measure and filter, without the split.

The split is exact over a whole table, so it stays with the batch job, which can read what this
one has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from loomset.errors import ConfigError
from loomset.functions.tokens import token_count
from loomset.operators.formatting import drop_long_rows, format_rows, measure_rows
from loomset.operators.identity import KEY, with_example_id
from loomset.params import DatasetParams
from loomset.sources.reader import with_fields
from loomset.sources.storage import exists

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# On the executors' disks, saved to the checkpoint with each batch: the keys need not fit the heap.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare_arrivals(
    spark: SparkSession,
    params: DatasetParams,
    directory: str,
    schema: StructType | str,
    source_format: str = "parquet",
    counter: Callable[[Column], Column] = token_count,
    distinct_keys: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Append the rows of files that are new below ``params.name_or_path``; all rows so far.

    Each run takes what has arrived since the last one and ends. Progress lies beside the rows, and
    the sink's log decides which of its files count, so a run that is killed and started again
    neither loses a row nor writes one twice. A row whose key was written before, as in a file that
    is delivered again, is passed over: rows of one key are taken to be one row. That costs an
    exchange of the kept rows and a store of all keys; ``distinct_keys`` says that the source never
    repeats one, and spares both.

    Defined results: a file without rows adds none; a null key is a key like any other; fields that
    ``schema`` lacks are null. Numbers of copies would need the whole table, so a key column is
    required.
    """
    if params.key is None:
        raise ConfigError("Rows that arrive one by one need a 'key' column.")
    reader = spark.readStream.schema(schema).format(source_format)
    if source_format == "json":
        reader = reader.option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = with_example_id(with_fields(reader.load(params.name_or_path)), params.key)
    formatted = format_rows(rows, params.system_prompt, params.chat_template)
    kept = drop_long_rows(measure_rows(formatted, params.max_seq_length, counter))
    if not params.keep_source:
        kept = kept.select(KEY, "text", "prompt", "target")
    if not distinct_keys:
        kept = kept.dropDuplicates([KEY])

    where = f"{directory.rstrip('/')}/rows"
    writer = kept.writeStream.format(params.file_format).option("path", where)
    if params.file_format == "json":
        writer = writer.option("ignoreNullFields", "false")
    if params.compression is not None:
        writer = writer.option("compression", params.compression)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        writer = writer.option("checkpointLocation", f"{directory.rstrip('/')}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    if not exists(spark, where):
        return spark.createDataFrame([], kept.schema)
    return spark.read.schema(kept.schema).format(params.file_format).load(where)
