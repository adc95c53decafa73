"""Instruction rows, prediction tables and a stand-in model made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions.text import user_turn
from loomset.operators.comparing import BASE, TUNED
from loomset.operators.identity import KEY

SYSTEM = "SYS"
PAIR_LIMIT = 512
DOCUMENT_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn after them, if any, and a context where there is one.

    The context is a document, else the conversation's system turn. The reply is found by an
    equi-join on conversation and turn number, not by a window over the conversation. Contexts
    repeat on one side of their join only, where adaptive execution splits a skewed partition.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    replies = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"), F.col("text").alias("document")
    )
    systems = turns.where("role = 'system'").select("conv_id", F.col("text").alias("system"))
    as_output = F.col("conv_id") % 7 == 0
    return (
        asked.join(replies, ["conv_id", "turn"], "left")
        .join(documents, "conv_id", "left")
        .join(systems, "conv_id", "left")
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias(KEY),
            "instruction",
            F.coalesce("document", "system").alias("context"),
            F.when(as_output, F.lit("")).otherwise(F.col("reply")).alias("response"),
            F.when(as_output, F.col("reply")).alias("output"),
        )
    )


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape the length filter and the split work on."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias(KEY), "text")


def _every_third(words: Column, first: int) -> Column:
    return F.filter(words, lambda _, i: i % 3 == first)


def predictions(rows: DataFrame) -> DataFrame:
    """What two stand-in models would have written.

    One repeats the user turn, the other writes the reply with every seventh word left out and the
    others reordered.
    """
    reply = F.coalesce(F.nullif(F.col("response"), F.lit("")), F.col("output"), F.lit(""))
    words = F.filter(F.split(reply, " "), lambda _, i: i % 7 != 5)
    shuffled = F.array_join(F.concat(*(_every_third(words, first) for first in (1, 0, 2))), " ")
    asked = user_turn(F.col("instruction"), F.col("context"))
    models = F.array(
        F.struct(F.lit(BASE).alias("model"), asked.alias("prediction")),
        F.struct(F.lit(TUNED).alias("model"), shuffled.alias("prediction")),
    )
    return rows.select(KEY, F.inline(models))


def make_echo():
    """A deterministic stand-in for a model: the words of the prompt in reverse."""

    def generate(prompts: list[str]) -> list[str]:
        return [f"{p} {' '.join(reversed(p.split(' ')))}<|im_end|>" for p in prompts]

    return generate


def make_copy():
    """Another stand-in: the prompt once more."""

    def generate(prompts: list[str]) -> list[str]:
        return [f"{p} {p}<|im_end|>" for p in prompts]

    return generate
