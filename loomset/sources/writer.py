"""Writing splits and small result tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loomset.errors import ConfigError
from loomset.sources.storage import names_in, publish, read_text, remove

# The names of the splits.
SPLITS = ("train", "validation", "test")
JOB_FILE = "_job.json"
# Forms of the splits and the compressions that Spark both writes and reads for them.
COMPRESSIONS = {
    "json": ("none", "bzip2", "deflate", "gzip"),
    "parquet": ("none", "snappy", "gzip", "zstd", "lz4"),
}
_COMMITS, _DATA = "_commits", "data-"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Commit:
    """One finished writing of the splits: where its files are and how to read them."""

    data: str
    schema: str
    file_format: str = "json"
    sizes: dict[str, int] | None = None
    job: str = ""


def write_splits(
    rows: DataFrame,
    directory: str,
    sizes: dict[str, int] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    job: str = "",
    file_format: str = "json",
    compression: str | None = None,
) -> None:
    """Write the rows by split, JSON Lines (null fields kept) or Parquet, and switch readers to them.

    The files go into a new folder, below ``split=<name>``. Only when ``check`` has passed on what
    was written does a small commit file name that folder; readers follow the last commit. A writing
    that fails or is killed before leaves the splits of the commit before it as they are. After the
    switch, older folders are removed, those of killed writings too, so one directory takes one
    writer at a time, and a reader under way has to be started again.

    Rows stay in the task that computed them; nothing is shuffled, and with a file open per split
    nothing is sorted either. The commit holds the schema, so that a reader needs no inference pass,
    known ``sizes``, to spare later counts, and what the ``job`` was.
    """
    if compression is not None and compression not in COMPRESSIONS.get(file_format, ()):
        raise ConfigError(f"No compression '{compression}' for '{file_format}': {COMPRESSIONS}")
    spark, where = rows.sparkSession, directory.rstrip("/")
    commit = Commit(f"{_DATA}{uuid.uuid4().hex}", rows.schema.json(), file_format, sizes, job)
    before = spark.conf.get(_OPEN_FILES)
    if int(before) < len(SPLITS):
        spark.conf.set(_OPEN_FILES, str(len(SPLITS)))
    try:
        writer = rows.write.partitionBy("split")
        if file_format == "json":
            writer = writer.option("ignoreNullFields", "false")
        if compression is not None:
            writer = writer.option("compression", compression)
        writer.format(file_format).save(f"{where}/{commit.data}")
        if check is not None:
            check(read_commit(spark, where, commit))
    except BaseException:
        remove(spark, f"{where}/{commit.data}")
        raise
    finally:
        spark.conf.set(_OPEN_FILES, before)
    older = names_in(spark, f"{where}/{_COMMITS}")
    number = 1 + max((int(name.removesuffix(".json")) for name in older), default=0)
    publish(spark, f"{where}/{_COMMITS}/{number:08d}.json", json.dumps(asdict(commit)))
    for name in older:
        remove(spark, f"{where}/{_COMMITS}/{name}")
    for name in names_in(spark, where):
        if name.startswith(_DATA) and name != commit.data:
            remove(spark, f"{where}/{name}")


def last_commit(spark: SparkSession, directory: str) -> Commit | None:
    """The commit that readers follow, if any writing was finished there."""
    where = f"{directory.rstrip('/')}/{_COMMITS}"
    found = names_in(spark, where)
    return Commit(**json.loads(read_text(spark, f"{where}/{max(found)}"))) if found else None


def read_commit(spark: SparkSession, directory: str, commit: Commit) -> DataFrame:
    reader = spark.read.schema(StructType.fromJson(json.loads(commit.schema)))
    if commit.file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(commit.file_format).load(f"{directory.rstrip('/')}/{commit.data}")


def splits_finished(spark: SparkSession, directory: str, job: str | None = None) -> bool:
    """Whether complete splits lie there, and were made by that ``job`` if one is named."""
    commit = last_commit(spark, directory)
    return commit is not None and job in (None, commit.job)


def splits_mark(spark: SparkSession, directory: str) -> str:
    """What names this writing of the splits; empty if there is none."""
    commit = last_commit(spark, directory)
    return f"{commit.data} {commit.job}" if commit else ""


def require_free_name(rows: DataFrame) -> None:
    """The splits are told apart by a column of that name, so the source may not have one."""
    if "split" in {name.lower() for name in rows.columns}:
        raise ConfigError("The source has a column named 'split'; rename it before preparing.")


def write_small(rows: DataFrame, directory: str) -> None:
    """One JSON file for a table of a few rows."""
    rows.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(directory)
