import hashlib
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loomset.operators import identity
from loomset.operators.identity import with_example_id


def test_caller_key_is_used(examples):
    rows = examples(("a",), ("b",))
    assert with_example_id(rows, "example_id") is rows
    named = rows.withColumnRenamed("example_id", "k")
    assert [r.example_id for r in with_example_id(named, "k").orderBy("k").collect()] == [0, 1]


@pytest.mark.parametrize("words, run, runs", [(1 << 20, 1000, 4096), (1, 1000, 4096), (1 << 20, 3, 7)])
def test_copies_are_numbered_and_layout_does_not_matter(spark, tmp_path, monkeypatch, words, run, runs):
    # A filter of one word lets nearly every row pass; runs of three are more than seven for the hot row.
    monkeypatch.setattr(identity, "MOST_WORDS", words)
    monkeypatch.setattr(identity, "RUN", run)
    monkeypatch.setattr(identity, "MOST_RUNS", runs)
    # One row makes up more than a third of the table and lies in all input files.
    values = ["hot"] * 400 + [f"row {i % 300}" for i in range(600)]
    frame = spark.createDataFrame([(v, None) for v in values], "text string, note string")
    keyed = []
    for parts in (1, 7):
        path = str(tmp_path / f"p{parts}")
        frame.repartition(parts).write.parquet(path)
        read = spark.read.option("maxPartitionBytes", "4096").parquet(path)
        keyed.append(sorted((r.example_id, r.text) for r in with_example_id(read).collect()))
    assert keyed[0] == keyed[1]
    assert len({key for key, _ in keyed[0]}) == 1000
    numbers = Counter(text for _, text in keyed[0])
    for text, n in numbers.items():
        digest = hashlib.sha256(f"{len(text)}:{text}-".encode()).hexdigest()
        assert {k for k, t in keyed[0] if t == text} == {f"{digest}-{i}" for i in range(n)}


def test_values_cannot_run_into_each_other(spark):
    frame = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc")], "a string, b string")
    assert with_example_id(frame).select(F.substring("example_id", 1, 64)).distinct().count() == 4


def test_nested_and_number_columns(spark):
    frame = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [1])], "a int, b array<int>")
    assert with_example_id(frame).select("example_id").distinct().count() == 3


def test_nested_values_differ_by_null_fields_and_microseconds(spark):
    frame = spark.sql(
        """select * from values
        (named_struct('a', cast(null as int), 'at', timestamp'2020-01-01 00:00:00.000001'), map('k', cast(null as int))),
        (named_struct('a', cast(null as int), 'at', timestamp'2020-01-01 00:00:00.000002'), map('k', cast(null as int))),
        (named_struct('a', cast(null as int), 'at', timestamp'2020-01-01 00:00:00.000002'), map('m', cast(null as int))),
        (named_struct('a', cast(null as int), 'at', timestamp'2020-01-01 00:00:00.000002'), map('m', cast(null as int)))
        as t(s, m)"""
    )
    keyed = with_example_id(frame)
    assert keyed.select("example_id").distinct().count() == 4
    assert sorted(str(r[:2]) for r in keyed.collect()) == sorted(str(r[:2]) for r in frame.collect())


def test_only_rows_that_may_be_copies_are_exchanged(spark, tmp_path):
    texts = [f"row {i}" for i in range(2000)] + ["twice", "twice"] + ["hot"] * 1500
    frame = spark.createDataFrame([(t, i % 3) for i, t in enumerate(texts)], "text string, n int").select("text")
    keyed = identity.with_content_id(frame, str(tmp_path))
    assert keyed.count() == len(texts)
    plan = plan_of(keyed)
    assert "SortMergeJoin" not in plan and "Window" not in plan
    # The one exchange of rows is that of the runs of copies; the stored rows are only asked for their word.
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanged) == 1 and "_first" in exchanged[0]
    counted = spark.read.parquet(str(tmp_path / "counted"))
    assert {r["_row"]["text"]: r["_n"] for r in counted.where("_n > 1").collect()} == {"twice": 2, "hot": 1500}
    assert counted.count() < 100


def test_the_filter_holds_all_it_was_given_and_little_else(spark):
    inside = spark.range(20_000).select(F.col("id").cast("string").alias("__content"))
    outside = spark.range(20_000, 60_000).select(F.col("id").cast("string").alias("__content"))
    n_words = 1 << 13
    words = identity.bloom_filter(inside.select(F.xxhash64("__content").alias("__hash")), n_words)
    assert words.count() <= n_words
    assert identity.with_may_repeat(inside, words, n_words).where("not __may_repeat").count() == 0
    assert identity.with_may_repeat(outside, words, n_words).where("__may_repeat").count() < 800


def test_no_rows_odd_names_and_a_key_of_its_own(spark):
    empty = spark.createDataFrame([], "text string")
    assert with_example_id(empty).count() == 0
    odd = spark.createDataFrame([("x", 1, 7), ("x", 1, 7), (None, 1, 7)], "`a.b` string, `_row` int, _number int")
    keyed = with_example_id(odd)
    assert keyed.columns == ["a.b", "_row", "_number", "example_id"]
    assert sorted(r["example_id"][64:] for r in keyed.collect()) == ["-0", "-0", "-1"]
    own = spark.createDataFrame([("x", "k"), ("x", "k")], "text string, example_id string")
    assert with_example_id(own).columns == ["text", "example_id"]
    assert with_example_id(own).select("example_id").distinct().count() == 2


def test_a_source_that_changes_order_is_numbered_once(spark):
    rows = spark.range(400).select((F.col("id") % 7).cast("string").alias("text")).orderBy(F.rand())
    assert with_example_id(rows).select("example_id").distinct().count() == 400
