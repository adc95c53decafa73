import hashlib
import math
import random

import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset.errors import ConfigError, DuplicateKeyError, EmptySplitError, TooFewExamplesError
from loomset.operators import gates, splitting
from loomset.operators.splitting import SplitSizes, assign_split, split_hash, split_rows


@pytest.mark.parametrize(
    "rows, sizes",
    [(10, (8, 1, 1)), (11, (8, 1, 2)), (1, (0, 0, 1)), (0, (0, 0, 0)), (10_000, (8000, 1000, 1000))],
)
def test_sizes(rows, sizes):
    assert tuple(SplitSizes.of(rows, 0.1, 0.1).as_dict().values()) == sizes


@given(st.integers(0, 10**12), st.integers(0, 100), st.integers(0, 100))
@settings(max_examples=200, deadline=None)
def test_sizes_cover_all_rows(rows, a, b):
    if a + b > 100:
        return
    sizes = SplitSizes.of(rows, a / 100, b / 100)
    assert sum(sizes.as_dict().values()) == rows
    assert min(sizes.as_dict().values()) >= 0
    held = sizes.validation + sizes.test
    assert held == math.ceil(round((a + b) / 100 * rows, 9)) or held == rows


def ranked(keys, seed, sizes):
    order = sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    held = sizes.test + sizes.validation
    names = ["test"] * sizes.test + ["validation"] * sizes.validation
    return dict(zip(order, names + ["train"] * (len(order) - held)))


@pytest.mark.parametrize("fetch", [1, 50, 4096])
def test_equals_a_global_ranking(spark, monkeypatch, fetch):
    monkeypatch.setattr(splitting, "FETCH_ROWS", fetch)
    keys = random.Random(7).sample(range(10**9), 3001)
    frame = spark.createDataFrame([(k,) for k in keys], "example_id long")
    got = {r.example_id: r.split for r in split_rows(frame, 0.15, 0.05, 9).collect()}
    assert got == ranked(keys, 9, SplitSizes.of(len(keys), 0.15, 0.05))


def test_membership_does_not_depend_on_layout_but_on_seed(spark):
    frame = spark.range(500).withColumnRenamed("id", "example_id")
    first = {r.example_id: r.split for r in split_rows(frame, 0.1, 0.1, 1).collect()}
    again = split_rows(frame.repartition(13).orderBy(F.desc("example_id")), 0.1, 0.1, 1)
    assert {r.example_id: r.split for r in again.collect()} == first
    other = {r.example_id: r.split for r in split_rows(frame, 0.1, 0.1, 2).collect()}
    assert other != first


@pytest.mark.parametrize("shares", [(0.0, 0.1), (0.1, 0.0), (0.0, 0.0), (0.5, 0.5)])
def test_empty_splits(spark, shares):
    frame = spark.range(100).withColumnRenamed("id", "example_id")
    got = split_rows(frame, *shares, 3).groupBy("split").count().collect()
    sizes = SplitSizes.of(100, *shares).as_dict()
    assert {r["split"]: r["count"] for r in got} == {k: v for k, v in sizes.items() if v}


def test_a_key_with_a_third_of_the_rows_is_an_error_not_a_wrong_split(spark, monkeypatch):
    monkeypatch.setattr(splitting, "FETCH_ROWS", 20)
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("example_id")
    )
    # With every share tried, at least one border falls among the copies of the hot key.
    failed = 0
    for held in (0.1, 0.3, 0.5, 0.7, 0.9):
        try:
            split_rows(frame, held / 2, held / 2, 5)
        except DuplicateKeyError:
            failed += 1
    assert failed


def test_a_row_without_a_key_is_refused(spark):
    frame = spark.createDataFrame([(1,), (None,), (3,)], "example_id long")
    with pytest.raises(ConfigError, match="1 rows have a null"):
        split_rows(frame, 0.1, 0.1, 1)


def test_assignment_is_a_projection(spark):
    frame = spark.range(1000).withColumnRenamed("id", "example_id")
    borders = splitting.SplitBorders("1" * 32, "2" * 32)
    plan = plan_of(assign_split(frame, split_hash(1), borders))
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_row_gate_is_inclusive():
    gates.require_rows("in the dataset", 1000, 1000)
    with pytest.raises(TooFewExamplesError, match="999 examples"):
        gates.require_rows("in the dataset", 999, 1000)


def test_split_gate():
    gates.require_splits({"train": 1, "validation": 1}, ("train", "validation"))
    with pytest.raises(EmptySplitError, match="validation=0"):
        gates.require_splits({"train": 5}, ("train", "validation"))
