"""One callable ``(spark, sf_dir) -> DataFrame`` per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.errors import SplitMismatchError
from loomset.functions import chat, text, tokens
from loomset.operators import comparing, gates, predicting, profiling, rouge, splitting
from loomset.operators.formatting import drop_long_rows, format_rows, measure_rows
from loomset.operators.identity import KEY, with_example_id
from loomset.params import DatasetParams, EvaluationParams, JobParams
from loomset.plans.evaluate import MODELS, evaluate
from loomset.plans.explore import explore
from loomset.plans.prepare import prepare_rows
from loomset.plans.training import training_text
from loomset.registry.adapters import (
    DOCUMENT_LIMIT,
    PAIR_LIMIT,
    SYSTEM,
    document_rows,
    instruction_rows,
    make_copy,
    make_echo,
    predictions,
    table,
)
from loomset.sources.reader import load_rows, load_split, load_splits
from loomset.sources.storage import scratch
from loomset.sources.writer import write_splits
from loomset.streaming.arrivals import prepare_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _user() -> F.Column:
    return text.user_turn(F.col("instruction"), F.col("context"))


def _reply() -> F.Column:
    return text.answer(F.col("response"), F.col("output"))


def _formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_rows(instruction_rows(spark, sf_dir), SYSTEM)


def _measured_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_rows(document_rows(spark, sf_dir), DOCUMENT_LIMIT)


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_long_rows(measure_rows(_formatted(spark, sf_dir), PAIR_LIMIT))


def _params(directory: str) -> DatasetParams:
    return DatasetParams(
        name_or_path="conversations",
        processed_dir=directory,
        min_examples=1,
        max_seq_length=PAIR_LIMIT,
        system_prompt=SYSTEM,
        key=KEY,
    )


def _prepared(spark: SparkSession, sf_dir: str, **form: str) -> DatasetParams:
    """Run the prepare job into a new scratch directory."""
    params = replace(_params(scratch(spark, "splits")), **form)
    prepare_rows(instruction_rows(spark, sf_dir), params)
    return params


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir)
    return rouge.pair_up(rows.select(KEY, _reply().alias("target")), predictions(rows))


def _rounded(scores: DataFrame) -> DataFrame:
    values = {name: F.round(name, 6) for name in ("precision", "recall", "f1")}
    return scores.withColumns(values)


# --- sources and sinks ---------------------------------------------------------------------


@query
def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_rows(spark, f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )


@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch(spark, "roundtrip")
    rows = _formatted(spark, sf_dir)
    write_splits(rows.withColumn("split", F.lit("train")), directory)
    return load_splits(spark, directory).select(
        KEY,
        "instruction",
        F.coalesce("context", F.lit("<null>")).alias("context"),
        "response",
        F.coalesce("output", F.lit("<null>")).alias("output"),
        "text",
        "prompt",
        "target",
        "split",
    )


@query
def split_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prepare job, read back."""
    params = _prepared(spark, sf_dir)
    return load_splits(spark, params.processed_dir).select(KEY, "split", "text", "prompt", "target")


@query
def split_reload_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with splits in compressed Parquet, of which only these columns are read."""
    params = _prepared(spark, sf_dir, file_format="parquet", compression="zstd")
    return load_splits(spark, params.processed_dir).select(KEY, "split", "text", "prompt", "target")


@query
def split_redo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced redo that fails after writing; the splits of the job before it are read."""
    params = _prepared(spark, sf_dir, compression="gzip")
    rows = load_splits(spark, params.processed_dir)

    def refuse(_written: DataFrame) -> None:
        raise SplitMismatchError("the source changed")

    with suppress(SplitMismatchError):
        write_splits(rows.where(F.col("split") != "train"), params.processed_dir, check=refuse)
    return load_splits(spark, params.processed_dir).select(KEY, "split", "text", "prompt", "target")


@query
def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive in two lots: those without a context, then all, so that some come twice."""
    source, directory = scratch(spark, "arriving"), scratch(spark, "arrived")
    params = replace(_params(directory), name_or_path=source, file_format="parquet")
    rows = instruction_rows(spark, sf_dir)
    rows.where("context is null").write.parquet(source)
    prepare_arrivals(spark, params, directory, rows.schema)
    rows.write.mode("append").parquet(source)
    return prepare_arrivals(spark, params, directory, rows.schema).select(KEY, "instruction", "text", "prompt", "target")


# --- projections ---------------------------------------------------------------------------


@query
def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\xa0\n \u2003"), F.col("text"), F.lit("\t\u3000\x1c\x85"))
    return document_rows(spark, sf_dir).select(KEY, text.strip(padded).alias("stripped"))


@query
def user_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_rows(spark, sf_dir).select(KEY, _user().alias("user_turn"))


@query
def response_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_rows(spark, sf_dir).select(KEY, _reply().alias("target"))


@query
def message_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.col("messages")
    return (
        instruction_rows(spark, sf_dir)
        .select(KEY, chat.full_messages(SYSTEM, _user(), _reply()).alias("messages"))
        .select(
            KEY,
            F.size(messages).alias("n_messages"),
            F.array_join(messages["role"], "|").alias("roles"),
            F.array_join(messages["content"], "|").alias("contents"),
        )
    )


@query
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_rows(instruction_rows(spark, sf_dir), SYSTEM, chat.PHI3).select(
        KEY, "prompt", "text"
    )


@query
def chatml_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(spark, sf_dir).select(KEY, "prompt", "text")


@query
def formatted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(spark, sf_dir).select(KEY, "instruction", "text", "prompt", "target")


@query
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_rows(spark, sf_dir).select(KEY, tokens.token_count(F.col("text")).alias("num_tokens"))


@query
def within_limit_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = measure_rows(_formatted(spark, sf_dir), PAIR_LIMIT)
    return measured.select(KEY, "num_tokens", "within_limit")


@query
def prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select(KEY, "instruction", "text", "prompt", "target")


@query
def text_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = training_text(spark, _prepared(spark, sf_dir))
    parts = [rows.withColumn("split", F.lit(name)) for name, rows in texts.items()]
    return parts[0].unionByName(parts[1])


@query
def prompt_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = _prepared(spark, sf_dir)
    return load_split(spark, params.processed_dir, "test").select(KEY, "prompt", "target")


@query
def word_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.word_lengths(instruction_rows(spark, sf_dir))


@query
def preview_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.preview(_formatted(spark, sf_dir))


@query
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of documents told apart by text and language alone, so copies are numbered."""
    return with_example_id(table(spark, sf_dir, "documents").select("text", "lang")).select(
        KEY, F.length("text").alias("n_chars"), "lang"
    )


# --- filters and gates ---------------------------------------------------------------------


@query
def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_long_rows(_measured_documents(spark, sf_dir))


@query
def length_drop_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.length_report(_measured_documents(spark, sf_dir))


@query
def row_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_report(_measured_documents(spark, sf_dir), 1000)


@query
def empty_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _kept(spark, sf_dir)
    split = splitting.split_rows(kept.select(KEY), 0.1, 0.1, 42)

    def rows(name: str) -> F.Column:
        return F.count_if(F.col("split") == name)

    return split.agg(
        rows("train").alias("train_rows"),
        rows("validation").alias("validation_rows"),
        ((rows("train") > 0) & (rows("validation") > 0)).alias("passed"),
    )


# --- splitting -----------------------------------------------------------------------------


@query
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_rows(document_rows(spark, sf_dir), 0.1, 0.1, 42).select(KEY, "split")


@query
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _kept(spark, sf_dir).select(KEY)
    return splitting.split_sizes(splitting.split_rows(kept, 0.1, 0.1, 42))


@query
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = splitting.split_rows(document_rows(spark, sf_dir).select(KEY), 0.1, 0.1, 42)
    planned = {"train": 0.8, "validation": 0.1, "test": 0.1}
    return comparing.split_summary(splitting.split_sizes(split), "documents", planned)


# --- profile -------------------------------------------------------------------------------


@query
def word_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all documents, the text taken as the instruction."""
    rows = document_rows(spark, sf_dir).select(
        KEY, F.col("text").alias("instruction"), F.lit("").alias("context"), F.lit("").alias("response")
    )
    return _rounded_profile(profiling.length_profile(rows, sample=None))


@query
def word_length_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploration's own sample of the first 500 rows."""
    rows = document_rows(spark, sf_dir).withColumnRenamed("text", "instruction")
    empty = F.lit(None).cast("string")
    return _rounded_profile(
        profiling.length_profile(rows.withColumns({"context": empty, "response": empty}))
    )


def _rounded_profile(profile: DataFrame) -> DataFrame:
    return profile.withColumns(
        {name: F.round(name, 6) for name in ("mean_words", "p95_words")}
    )


# --- inference -----------------------------------------------------------------------------


@query
def prompt_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_rows(spark, sf_dir).select(
        KEY, tokens.first_tokens(F.col("text"), DOCUMENT_LIMIT).alias("prompt")
    )


@query
def prediction_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _formatted(spark, sf_dir)
    output = F.concat("prompt", F.lit(" \n"), "target", F.lit("<|im_end|>"))
    return rows.select(KEY, predicting.clean_prediction(output, F.col("prompt"), 128).alias("prediction"))


@query
def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicting.batch_predict(_formatted(spark, sf_dir), make_echo, "base_model")


# --- scoring -------------------------------------------------------------------------------


@query
def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query
def alignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All targets against the tuned model's predictions of the kept rows and a doubled base."""
    rows = instruction_rows(spark, sf_dir)
    made = predictions(rows)
    base = made.where("model = 'base_model'")
    tuned = predictions(_kept(spark, sf_dir)).where("model = 'fine_tuned_model'")
    return rouge.alignment(rows.select(KEY), base.union(base).union(tuned), MODELS)


@query
def rouge1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rouge.ngram_scores(_pairs(spark, sf_dir), ("rouge1",)))


@query
def rouge2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rouge.ngram_scores(_pairs(spark, sf_dir), ("rouge2",)))


@query
def rougeL(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rouge.lcs_scores(_pairs(spark, sf_dir)))


@query
def rougeLsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rouge.summary_scores(_pairs(spark, sf_dir)))


@query
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rouge.corpus_scores(rouge.rouge_scores(_pairs(spark, sf_dir)))
    return scores.withColumn("value", F.round("value", 6))


@query
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tuned model has no ROUGE-2, so that a metric of one side only is covered."""
    pairs = _pairs(spark, sf_dir)
    counted = rouge.ngram_scores(pairs).where("model = 'base_model' or metric = 'rouge1'")
    compared = comparing.compare_models(rouge.corpus_scores(counted))
    return compared.select(
        "metric", *[F.round(name, 6).alias(name) for name in (*MODELS, "delta")]
    )


@query
def qualitative_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir)
    return comparing.side_by_side(format_rows(rows, SYSTEM), predictions(rows), 5)


@query
def evaluation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepare and evaluate jobs end to end; the comparison table of the test split."""
    dataset = _prepared(spark, sf_dir)
    scored = EvaluationParams(scratch(spark, "results"))
    test = load_split(spark, dataset.processed_dir, "test")
    result = evaluate(spark, JobParams(dataset, scored), predictions=predictions(test))
    return _rounded_comparison(result.comparison)


@query
def evaluation_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluate, then again with the two models' predictions exchanged: the second comparison."""
    dataset = _prepared(spark, sf_dir)
    job = JobParams(dataset, EvaluationParams(scratch(spark, "results"), metrics=("rouge1",)))
    made = predictions(load_split(spark, dataset.processed_dir, "test"))
    evaluate(spark, job, predictions=made)
    other = F.when(F.col("model") == MODELS[0], MODELS[1]).otherwise(MODELS[0])
    result = evaluate(spark, job, predictions=made.withColumn("model", other), force=True)
    return _rounded_comparison(result.comparison)


@query
def evaluation_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluate a finished table, then two generators, unforced: the generators' comparison."""
    dataset = _prepared(spark, sf_dir)
    job = JobParams(dataset, EvaluationParams(scratch(spark, "results"), metrics=("rouge1",)))
    test = load_split(spark, dataset.processed_dir, "test")
    evaluate(spark, job, predictions=predictions(test))
    result = evaluate(spark, job, dict(zip(MODELS, (make_echo, make_copy))))
    return _rounded_comparison(result.comparison)


@query
def score_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus scores with the bootstrap interval around them."""
    scores = rouge.rouge_scores(_pairs(spark, sf_dir), ("rouge1", "rouge2"))
    found = rouge.corpus_intervals(rouge.resampled_scores(scores))
    return found.withColumns({name: F.round(name, 6) for name in ("value", "low", "mid", "high")})


@query
def written_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side-by-side sample of the evaluate job, as stored and read back."""
    dataset = _prepared(spark, sf_dir)
    job = JobParams(dataset, EvaluationParams(scratch(spark, "results"), metrics=("rouge1",)))
    test = load_split(spark, dataset.processed_dir, "test")
    return evaluate(spark, job, predictions=predictions(test)).examples


@query
def explore_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count, word lengths of the first 500 rows and the first formatted row of the documents."""
    rows = document_rows(spark, sf_dir).withColumnRenamed("text", "instruction")
    empty = F.lit(None).cast("string")
    rows = rows.withColumns({name: empty for name in ("context", "response", "output")})
    profile = explore(rows, KEY, system_prompt=SYSTEM)
    lengths = _rounded_profile(profile.word_lengths)
    return lengths.crossJoin(profile.preview).withColumn("all_rows", F.lit(profile.rows))


@query
def json_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON Lines, loaded by name with a key column and formatted: no column is lost."""
    where = f"{scratch(spark, 'documents')}.jsonl"
    table(spark, sf_dir, "documents").withColumnRenamed("text", "instruction").write.json(where)
    rows = with_example_id(load_rows(spark, where), "doc_id")
    return format_rows(rows, SYSTEM).drop("context", "response", "output")


def _rounded_comparison(comparison: DataFrame) -> DataFrame:
    return comparison.select(
        "metric", *[F.round(name, 6).alias(name) for name in (*MODELS, "delta")]
    )
