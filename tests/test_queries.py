"""Every registered query against its SQL on the smallest tables, and the survey's golden values."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_queries  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from loomset.registry import adapters, oracles, queries  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    return check_queries.open_tables(SMALL)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, database, name):
    ours = contract.queries()[name](spark, SMALL).toPandas()
    assert len(ours)
    if name in contract.oracle_sql():
        theirs = database.sql(contract.oracle_sql()[name]).df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert check_queries.normal(ours) == check_queries.normal(theirs)


def test_every_query_of_the_library_has_sql():
    assert set(queries.QUERIES) == set(oracles.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert {r["split"] for r in contract.entry(spark).collect()} == {"train", "validation", "test"}


def test_golden_values(spark):
    rows = adapters.instruction_rows(spark, MIDDLE)
    assert rows.count() == 279
    assert rows.where("context is not null").count() == 279
    assert rows.where("output is not null").count() == 31
    assert rows.where("response is null").count() == 39
    report = queries.length_drop_report(spark, MIDDLE).first()
    assert (report.rows_before, report.rows_dropped) == (1000, 29)
    gates = {r.stage: (r.n, r.passed) for r in queries.row_gate(spark, MIDDLE).collect()}
    assert gates == {"raw": (1000, True), "kept": (971, False)}
    counted = queries.within_limit_flag(spark, MIDDLE)
    totals = counted.selectExpr("min(num_tokens)", "max(num_tokens)", "sum(num_tokens)").first()
    assert tuple(totals) == (95, 2678, 198733)
    base = queries.rougeL(spark, MIDDLE).where("model = 'base_model'")
    assert base.agg({"hits": "sum"}).first()[0] > 0
