"""Reading instruction rows and finished splits."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomset.errors import DatasetLoadError, MissingSplitError
from loomset.operators.identity import KEY, content_key
from loomset.sources.arrays import array_as_lines
from loomset.sources.storage import exists, first_visible_byte, scratch, total_bytes
from loomset.sources.writer import last_commit, read_commit

# The fields of an instruction row.
FIELDS = ("instruction", "context", "response", "output")
# For tables made in code; reading JSON infers its own columns.
EXAMPLE_SCHEMA = StructType([StructField(name, StringType()) for name in FIELDS])
JSON_SUFFIXES = (".json", ".jsonl")
# Arrays of more bytes are cut for several tasks, at some ten times the work; one task reads a smaller
# one, and holds all of its rows at once.
ARRAY_BYTES = 256 << 20
# What Spark calls a failed read, as opposed to a failure of the work done on the rows.
_READ_FAILURES = (
    "FAILED_READ_FILE",
    "INVALID_JSON_RECORD_TYPE",
    "MALFORMED_RECORD_IN_PARSING",
    "MALFORMED_RECORD_DETECTED_IN_RECORD_PARSING",
    "Malformed records are detected",
    "PATH_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "FileNotFoundException",
    "CANNOT_READ_FILE_FOOTER",
)


@contextmanager
def loading(name: str) -> Iterator[None]:
    """Turn a failed read into one error that names the dataset.

    Spark reads lazily, so this belongs around the read and around the first action on it.
    """
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if any(mark in str(error) for mark in _READ_FAILURES):
            raise DatasetLoadError(name, error) from error
        raise


def load_rows(
    spark: SparkSession,
    name: str,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read instruction rows from a JSON file, a Parquet path or a catalog table.

    All columns of the source are kept. For JSON, Spark infers them with one more pass over the
    input; a ``schema`` spares that pass and keeps the columns it lists. Missing fields become null
    columns, and the four fields are text whatever was inferred. A ``.json`` file that holds one
    array is cut at its elements first if it is large, which stores them once more; lines need not be.
    """
    with loading(name):
        if not exists(spark, name):
            rows = spark.table(name)
        elif name.rstrip("/").endswith(JSON_SUFFIXES):
            whole = first_visible_byte(spark, name) == "["
            lines = name
            if whole and total_bytes(spark, name) > ARRAY_BYTES:
                whole, lines = False, _cut_array(spark, name)
            reader = spark.read.option("mode", "FAILFAST").option("multiLine", whole)
            rows = (reader if schema is None else reader.schema(schema)).json(lines)
        else:
            rows = spark.read.parquet(name)
    return with_fields(rows)


def _cut_array(spark: SparkSession, name: str) -> str:
    try:
        return array_as_lines(spark, name, scratch(spark, "array"))
    except ValueError as error:
        raise DatasetLoadError(name, error) from error


def with_fields(rows: DataFrame) -> DataFrame:
    """The four fields as text, null where the source has none; all other columns as they are."""
    present = {name.lower(): kind for name, kind in rows.dtypes}
    made = {
        field: (F.col(field) if field in present else F.lit(None)).cast("string")
        for field in FIELDS
        if present.get(field) != "string"
    }
    return rows.withColumns(made) if made else rows


def load_test_file(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """A test split that lies in one JSON Lines file: key, prompt and target.

    Rows without an ``example_id`` are keyed by the column ``key`` if there is one, else by content.
    """
    with loading(path):
        rows = spark.read.option("mode", "FAILFAST").json(path)
    missing = sorted({"prompt", "target"} - set(rows.columns))
    if missing:
        raise DatasetLoadError(path, ValueError(f"no column {', '.join(missing)}"))
    if KEY not in rows.columns:
        rows = rows.withColumn(KEY, F.col(key) if key in rows.columns else content_key(rows))
    return rows.select(KEY, "prompt", "target")


def load_splits(spark: SparkSession, directory: str) -> DataFrame:
    """All splits of the last finished writing; filter on ``split`` to read only that part's files."""
    commit = last_commit(spark, directory)
    if commit is None:
        raise MissingSplitError(directory)
    return read_commit(spark, directory, commit)


def load_split(spark: SparkSession, directory: str, split: str) -> DataFrame:
    """One finished split."""
    return load_splits(spark, directory).where(F.col("split") == split)


def load_sizes(spark: SparkSession, directory: str) -> DataFrame:
    """``(split, rows)`` of finished splits, as saved with them or else counted."""
    commit = last_commit(spark, directory)
    if commit is None or commit.sizes is None:
        return load_splits(spark, directory).groupBy("split").agg(F.count("*").alias("rows"))
    return spark.createDataFrame(list(commit.sizes.items()), "split string, rows long")
