"""The numbered queries over the driver's tables, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import (
    collocations,
    exact_dedup,
    language_id,
    lm_scoring,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    runs,
    sharding,
    simhash,
    toxicity,
    warc,
)
from loomset.llm.common import fold, stored, table, text_bytes
from loomset.sources.storage import scratch

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules.judge(docs, table(spark, sf_dir, "labels"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    return lm_scoring.score_texts(docs, ["doc_id", "held_out"], "not held_out")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = fold(F.col("doc_id"), 3)
    known = toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"), remainder != 1)
    return toxicity.score(docs, toxicity.fit(known), ["doc_id"]).select(
        F.col("__row.doc_id").alias("doc_id"),
        (fold(F.col("__row.doc_id"), 3) == 1).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = stored(packing.tokenize_pieces(docs, with_ids=False).drop("ids"), "pieces")
    return packing.pack(pieces).withColumnRenamed("key", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    return mixing.mix(sized, size=F.col("words")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, scratch(spark, "slot-map")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), where)
    return warc.read_archive(spark, where).withColumnRenamed("id", "page_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = language_id.fit(docs.where("not held_out"))
    return language_id.predict(docs, model, ["doc_id", "held_out"])


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return quality_classifier.score(docs, model, ["doc_id"]).select(
        F.col("__row.doc_id").alias("doc_id"),
        (fold(F.col("__row.doc_id"), 5) == 0).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("crc", F.crc32(text_bytes(F.col("doc_id").cast("string"))))
    found = runs.collapse_runs(docs, ["doc_id"], rewrite=runs.repeat_tail, key="crc")
    # Greatest length first; among those the smallest start, then the smallest period.
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        F.col("__row.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["s"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["p"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["p"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash": op5_simhash,
    "op6_mix_sources": op6_mix_sources,
    "op7_shard_documents": op7_shard_documents,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc_archive": op9_warc_archive,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_periodic_runs": op13_periodic_runs,
}
