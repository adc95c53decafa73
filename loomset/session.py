"""A Spark session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "loomset", **settings: str) -> SparkSession:
    """Session with adaptive execution; the cluster's own settings win unless given here.

    Adaptive execution sizes shuffle partitions and splits skewed join partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
