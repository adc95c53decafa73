import pytest
from pyspark.sql import functions as F

from loomset.errors import ConfigError
from loomset.operators.formatting import drop_long_rows, format_rows, measure_rows
from loomset.params import DatasetParams
from loomset.streaming.arrivals import prepare_arrivals

SCHEMA = "row long, instruction string, response string"


def lot(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").alias("row"),
        F.concat(F.lit("ask "), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int"))).alias("instruction"),
        F.when(F.col("id") % 5 > 0, "reply").alias("response"),
    )


def given(tmp_path, **more):
    more = {"key": "row", "max_seq_length": 40} | more
    return DatasetParams(str(tmp_path / "in"), "unused", **more)


def in_one_go(rows, params):
    keyed = rows.withColumn("example_id", F.col("row")).withColumns({"context": F.lit(None).cast("string"), "output": F.lit(None).cast("string")})
    kept = drop_long_rows(measure_rows(format_rows(keyed, params.system_prompt), params.max_seq_length))
    return sorted(map(tuple, kept.select("example_id", "text", "prompt", "target").collect()))


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_lots_equal_one_batch(spark, tmp_path, file_format):
    params = given(tmp_path, file_format=file_format)
    out = str(tmp_path / "out")
    lot(spark, 0, 60).repartition(3).write.parquet(params.name_or_path)
    first = prepare_arrivals(spark, params, out, SCHEMA, files_per_batch=1)
    assert sorted(map(tuple, first.select("example_id", "text", "prompt", "target").collect())) == in_one_go(lot(spark, 0, 60), params)
    # The second lot brings some rows of the first again, and some of its own twice.
    lot(spark, 30, 100).union(lot(spark, 90, 100)).write.mode("append").parquet(params.name_or_path)
    done = prepare_arrivals(spark, params, out, SCHEMA)
    expected = in_one_go(lot(spark, 0, 100), params)
    assert 0 < len(expected) < 100
    assert sorted(map(tuple, done.select("example_id", "text", "prompt", "target").collect())) == expected
    # Nothing new: nothing is written.
    assert prepare_arrivals(spark, params, out, SCHEMA).count() == len(expected)


def test_files_outside_the_log_do_not_count(spark, tmp_path):
    params = given(tmp_path, file_format="parquet", keep_source=False)
    lot(spark, 0, 10).write.parquet(params.name_or_path)
    done = prepare_arrivals(spark, params, str(tmp_path / "out"), SCHEMA, distinct_keys=True)
    expected = len(in_one_go(lot(spark, 0, 10), params))
    assert done.columns == ["example_id", "text", "prompt", "target"] and done.count() == expected > 0
    # What a killed task leaves beside the files of the log.
    done.write.mode("append").parquet(str(tmp_path / "stray"))
    for file in (tmp_path / "stray").glob("part-*"):
        (tmp_path / "out" / "rows" / file.name).write_bytes(file.read_bytes())
    assert prepare_arrivals(spark, params, str(tmp_path / "out"), SCHEMA, distinct_keys=True).count() == expected


def test_nothing_has_arrived_or_no_key(spark, tmp_path):
    params = given(tmp_path)
    (tmp_path / "in").mkdir()
    assert prepare_arrivals(spark, params, str(tmp_path / "out"), SCHEMA).count() == 0
    with pytest.raises(ConfigError, match="key"):
        prepare_arrivals(spark, given(tmp_path, key=None), str(tmp_path / "out"), SCHEMA)
