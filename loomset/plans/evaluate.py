"""Evaluate job: predict with two models, score both, compare."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loomset.errors import AlignmentError, EmptySplitError, MissingSplitError
from loomset.operators.comparing import BASE, TUNED, compare_models, side_by_side, split_summary
from loomset.operators.identity import KEY
from loomset.operators.predicting import Generator, batch_predict
from loomset.operators.rouge import corpus_intervals, pair_up, require_alignment, resampled_scores, rouge_scores
from loomset.params import EvaluationParams, JobParams
from loomset.sources.reader import JSON_SUFFIXES, load_sizes, load_split, load_test_file
from loomset.sources.storage import changed, exists, finished, read_text, remove, scratch, write_text
from loomset.sources.writer import JOB_FILE, splits_finished, splits_mark, write_small

MODELS = (BASE, TUNED)
_BUCKET = "bucket"


@dataclass(frozen=True)
class Evaluation:
    """Result tables: scores and examples as stored; intervals, comparison and summary from them."""

    scores: DataFrame
    examples: DataFrame
    comparison: DataFrame
    summary: DataFrame
    intervals: DataFrame


def evaluate(
    spark: SparkSession,
    params: JobParams,
    generators: Mapping[str, Callable[[], Generator]] | None = None,
    predictions: DataFrame | None = None,
    force: bool = False,
) -> Evaluation:
    """Score both models on the test split and write scores, examples and the comparison.

    Give either one generator factory per model or a finished table
    ``(example_id, model, prediction)``. Predictions are stored before they are used, since they
    are the expensive part. Finished results are kept unless forced, or asked for with other
    predictions, generators, parameters or splits: a table is known by its content, a generator by
    :func:`generator_name`. What is returned belongs to the scores; a stored report (comparison and
    summary) is never replaced.
    """
    wanted = params.evaluation
    if wanted is None:
        raise ValueError("evaluate needs the 'evaluation' parameters")
    if predictions is None and (generators is None or set(generators) != set(MODELS)):
        raise ValueError(f"give predictions, or one generator factory each for {MODELS}")
    root = wanted.results_dir.rstrip("/")
    scores_dir, examples_dir, resamples_dir = (f"{root}/{n}" for n in ("metrics", "qualitative_examples", "resamples"))
    report_dir = wanted.report_path or f"{root}/report"

    test, sizes, source = _test_split(spark, params)
    if predictions is not None:
        made_by = {"table": table_name(predictions)}
    else:
        made_by = {m: generator_name(generators[m], wanted.versions.get(m, "")) for m in MODELS}
    given = [wanted.metrics, wanted.num_qualitative_examples, wanted.max_new_tokens, wanted.resamples]
    job = json.dumps([source, *given, made_by], sort_keys=True)
    mark = f"{root}/{JOB_FILE}"
    stored = all(finished(spark, where) for where in (scores_dir, examples_dir, resamples_dir))
    if force or not (stored and exists(spark, mark) and read_text(spark, mark) == job):
        if test.isEmpty():
            raise EmptySplitError({"test": 0})
        remove(spark, mark)  # until all results are new, they are nobody's
        held = scratch(spark, "test-rows")
        try:
            _in_buckets(test, wanted).write.partitionBy(_BUCKET).parquet(held)
            rows = spark.read.schema(StructType([*test.schema, StructField(_BUCKET, IntegerType())])).parquet(held)
            if predictions is not None:
                made = _stored_table(predictions, f"{root}/predictions/given")
            else:
                made = _predicted(rows, wanted, generators, made_by, f"{root}/predictions", force, source)
            rows = rows.drop(_BUCKET)
            require_alignment(rows, made, MODELS)
            scored = rouge_scores(pair_up(rows, made), wanted.metrics)
            write_small(resampled_scores(scored, wanted.resamples), resamples_dir)
            write_small(side_by_side(rows, made, wanted.num_qualitative_examples), examples_dir)
        finally:
            remove(spark, held)
        write_small(_resampled(spark, resamples_dir).where("draw = 0").drop("draw"), scores_dir)
        write_text(spark, mark, job)
    scores = spark.read.schema("model string, metric string, value double").json(scores_dir)
    comparison = compare_models(scores)
    summary = split_summary(sizes, params.dataset.name_or_path, params.dataset.planned)
    for name, table in (("comparison", comparison), ("summary", summary)):
        if not finished(spark, f"{report_dir}/{name}"):
            write_small(table, f"{report_dir}/{name}")
    text = "prompt string, ground_truth string, base_model_response string"
    key_type = test.schema[KEY].dataType.simpleString()
    examples = spark.read.schema(
        f"{KEY} {key_type}, {text}, fine_tuned_response string"
    ).json(examples_dir)
    return Evaluation(scores, examples, comparison, summary, corpus_intervals(_resampled(spark, resamples_dir)))


def _resampled(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.schema("model string, metric string, draw int, value double").json(directory)


def generator_name(factory: Callable[[], Generator], version: str = "") -> str:
    """What tells one generator from another: its name, the caller's version, and a digest.

    The digest is of the factory as it is sent to the workers: a function of a module counts by its
    name, a lambda, a closure or a partial by its code and what it holds. A change inside a module
    does not show; that is what the version is for.
    """
    name = f"{getattr(factory, '__module__', '')}.{getattr(factory, '__qualname__', type(factory).__name__)}"
    return f"{name} {version} {hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()}"


def table_name(predictions: DataFrame) -> str:
    """What tells one table of predictions from another: its row count and two sums of row hashes.

    One aggregate, whatever the order of the rows; equal rows do not cancel out.
    """
    columns = [KEY, "model", "prediction"]
    sums = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")) for salt in ("a", "b")]
    return " ".join(map(str, predictions.agg(F.count("*"), *sums).first()))


def _in_buckets(test: DataFrame, wanted: EvaluationParams) -> DataFrame:
    bucket = F.pmod(F.xxhash64(F.col(KEY).cast("string")), F.lit(wanted.buckets))
    return test.withColumn(_BUCKET, bucket.cast("int"))


def _test_split(spark: SparkSession, params: JobParams) -> tuple[DataFrame, DataFrame, str]:
    """Test rows, sizes of all splits, and what names this state of them.

    A test file may lie apart from the splits; their sizes are then those of the splits, if there
    are any, and else of the file alone.
    """
    named, processed = params.evaluation.test_file, params.dataset.processed_dir
    if named is None or not named.rstrip("/").endswith(JSON_SUFFIXES):
        where = named or processed
        test = load_split(spark, where, "test").select(KEY, "prompt", "target")
        return test, load_sizes(spark, where), f"{where} {splits_mark(spark, where)}"
    if not exists(spark, named):
        raise MissingSplitError(named)
    test = load_test_file(spark, named, params.dataset.key)
    if splits_finished(spark, processed):
        sizes = load_sizes(spark, processed)
    else:
        sizes = test.agg(F.lit("test").alias("split"), F.count("*").alias("rows"))
    return test, sizes, f"{named} {changed(spark, named)}"


def _stored_table(predictions: DataFrame, directory: str) -> DataFrame:
    """Write given predictions and read them back; rows of other models are an error."""
    other = predictions.where(~F.coalesce(F.col("model").isin(*MODELS), F.lit(False))).take(1)
    if other:
        raise AlignmentError(f"Predictions of model '{other[0]['model']}'; known: {MODELS}")
    predictions.select(KEY, "model", "prediction").write.mode("overwrite").parquet(directory)
    return predictions.sparkSession.read.parquet(directory)


def _predicted(
    rows: DataFrame,
    wanted: EvaluationParams,
    generators: Mapping[str, Callable[[], Generator]],
    made_by: Mapping[str, str],
    directory: str,
    force: bool,
    source: str,
) -> DataFrame:
    """Run both models over the prompts, bucket by bucket, and read their predictions back.

    A bucket that was finished earlier by the same generator on the same prompts is not run again, so
    after a failure a model goes on where it stopped. The rows lie by bucket, so each run reads its own.
    """
    spark = rows.sparkSession
    made = []
    for model in MODELS:
        where, mark = f"{directory}/{model}", f"{directory}/{model}-{JOB_FILE.lstrip('_')}"
        job = json.dumps([source, wanted.max_new_tokens, wanted.buckets, made_by[model]])
        if force or not exists(spark, mark) or read_text(spark, mark) != job:
            remove(spark, mark)
            remove(spark, where)
            write_text(spark, mark, job)
        for bucket in range(wanted.buckets):
            part = f"{where}/{_BUCKET}={bucket}"
            if not finished(spark, part):
                batch_predict(
                    rows.where(F.col(_BUCKET) == bucket),
                    generators[model],
                    model,
                    max_new_tokens=wanted.max_new_tokens,
                    partitions=wanted.partitions,
                ).write.mode("overwrite").parquet(part)
        made.append(where)
    kind = rows.schema[KEY].dataType.simpleString()
    reader = spark.read.schema(f"{KEY} {kind}, model string, prediction string, {_BUCKET} int")
    return reader.parquet(made[0]).unionByName(reader.parquet(made[1])).drop(_BUCKET)
