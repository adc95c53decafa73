"""Row counts that must hold before a job goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.errors import EmptySplitError, TooFewExamplesError


def require_rows(stage: str, found: int, minimum: int) -> None:
    """Fail below the minimum; exactly the minimum passes."""
    if found < minimum:
        raise TooFewExamplesError(stage, found, minimum)


def require_splits(sizes: dict[str, int], needed: tuple[str, ...]) -> None:
    if any(not sizes.get(name, 0) for name in needed):
        raise EmptySplitError({name: sizes.get(name, 0) for name in needed})


def length_report(measured: DataFrame) -> DataFrame:
    """Rows before and after the length filter, and how many it drops."""
    kept = F.count_if(F.col("within_limit"))
    return measured.agg(
        F.count("*").alias("rows_before"),
        kept.alias("rows_after"),
        (F.count("*") - kept).alias("rows_dropped"),
    )


def gate_report(measured: DataFrame, minimum: int) -> DataFrame:
    """Both minimum-size checks as one row each."""
    gates = length_report(measured).select(
        F.explode(
            F.array(
                F.struct(F.lit("raw").alias("stage"), F.col("rows_before").alias("n")),
                F.struct(F.lit("kept").alias("stage"), F.col("rows_after").alias("n")),
            )
        ).alias("gate")
    )
    return gates.select(
        "gate.stage",
        "gate.n",
        F.lit(minimum).cast("long").alias("minimum"),
        (F.col("gate.n") >= minimum).alias("passed"),
    )
