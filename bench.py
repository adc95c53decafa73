"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores. Every query runs
once to warm up and then three times; the median counts. Results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loomset.operators import rouge  # noqa: E402
from loomset.params import DatasetParams  # noqa: E402
from loomset.plans.prepare import prepare_rows  # noqa: E402
from loomset.registry import adapters  # noqa: E402
from loomset.registry.queries import QUERIES  # noqa: E402
from loomset.session import build_session  # noqa: E402
from loomset.sources.storage import scratch  # noqa: E402

NAMES = (
    "token_count",
    "length_filter",
    "split_assign",
    "content_ids",
    "word_length_profile",
    "render_template",
    "split_sizes",
    "rouge1",
    "rouge2",
    "rougeL",
    "rougeLsum",
    "model_scores",
    "evaluation_job",
)
RUNS = 3


def prepare_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole prepare job with every document as an instruction."""
    rows = adapters.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("example_id"),
        F.col("text").alias("instruction"),
        *[F.lit(None).cast("string").alias(name) for name in ("context", "response", "output")],
    )
    params = DatasetParams(
        "documents", scratch(spark, "bench"), min_examples=1, key="example_id", keep_source=False
    )
    return prepare_rows(rows, params).groupBy("split").count()


def stored_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Targets and predictions written once, so that pairing and scoring alone are timed."""
    rows = adapters.instruction_rows(spark, sf_dir)
    reply = F.coalesce(F.nullif(F.col("response"), F.lit("")), F.col("output"))
    path = scratch(spark, "sides")
    rows.select("example_id", reply.alias("target")).write.parquet(f"{path}/targets")
    adapters.predictions(rows).write.parquet(f"{path}/predictions")
    return spark.read.parquet(f"{path}/targets"), spark.read.parquet(f"{path}/predictions")


def seconds(build) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    targets, predictions = stored_sides(spark, sf_dir)
    timed = {"prepare_documents": seconds(lambda: prepare_documents(spark, sf_dir))}
    for name in NAMES:
        timed[name] = seconds(lambda: QUERIES[name](spark, sf_dir))
    timed["score_all_metrics"] = seconds(
        lambda: rouge.rouge_scores(rouge.pair_up(targets, predictions))
    )
    documents = adapters.table(spark, sf_dir, "documents").count()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "spark": spark.version,
                "rates": {
                    "prepare_documents_per_sec": round(documents / timed["prepare_documents"]),
                    "rouge_pairs_per_sec": round(
                        predictions.count() / timed["score_all_metrics"]
                    ),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
