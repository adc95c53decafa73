"""The tables behind the evaluation report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.operators.identity import KEY
from loomset.operators.splitting import SPLITS

# Names of the two models in all result tables.
BASE, TUNED = "base_model", "fine_tuned_model"


def compare_models(scores: DataFrame) -> DataFrame:
    """Both models' value per metric and the difference, sorted by metric.

    A metric only one model has stays in the table with the other side and the delta null.
    """

    def value_of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value"))).alias(model)

    return (
        scores.where(F.col("model").isin(BASE, TUNED))
        .groupBy("metric")
        .agg(value_of(BASE), value_of(TUNED))
        .withColumn("delta", F.col(TUNED) - F.col(BASE))
        .orderBy("metric")
    )


def side_by_side(test: DataFrame, predictions: DataFrame, examples: int) -> DataFrame:
    """The first examples by key with what both models wrote.

    The examples are chosen before the join, so only that many keys reach it.
    """
    chosen = test.select(KEY, "prompt", "target").orderBy(KEY).limit(examples)
    written = (
        predictions.join(chosen.select(KEY), KEY, "left_semi")
        .groupBy(KEY)
        .pivot("model", [BASE, TUNED])
        .agg(F.first("prediction"))
    )
    return (
        chosen.join(written, KEY, "left")
        .select(
            KEY,
            "prompt",
            F.col("target").alias("ground_truth"),
            F.col(BASE).alias("base_model_response"),
            F.col(TUNED).alias("fine_tuned_response"),
        )
        .orderBy(KEY)
    )


def split_summary(sizes: DataFrame, dataset: str, planned: dict[str, float]) -> DataFrame:
    """Planned share next to actual rows and share, from ``(split, rows)``."""
    total = F.sum("rows")

    def line(name: str) -> Column:
        rows = F.coalesce(F.sum(F.when(F.col("split") == name, F.col("rows"))), F.lit(0))
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(name).alias("split"),
            F.lit(planned[name]).alias("planned_share"),
            rows.alias("rows"),
            (rows / total).alias("actual_share"),
        )

    return sizes.agg(F.array(*[line(name) for name in SPLITS]).alias("lines")).select(
        F.inline("lines")
    )
