import base64
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomset.llm import warc
from loomset.sources.storage import scratch

from .conftest import ODD_TEXTS

PAGES = [
    *((i, f"http://a.b/{i}\r\nX: y", t) for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS[3:]])),
    (3, "http://again", "a"), (None, "http://null", "a"), (None, None, "alone"), (90, None, None),
]


@pytest.fixture
def archive(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, address string")
    where = scratch(spark, "warc")
    warc.write_archive(pages.repartition(5), where)
    return where


def test_records_round_trip(spark, archive):
    rows = warc.read_archive(spark, archive).collect()
    payloads = [(page, (html or "").encode()) for page, _, html in PAGES]
    assert len(rows) == len(payloads)
    expected = []
    for payload in {p for _, p in payloads}:
        ids = [i for i, p in payloads if p == payload]
        holder = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.remove(holder)
        expected.append((holder, len(payload), digest, "response", None))
        expected += [(i, len(payload), digest, "revisit", holder) for i in ids]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_payloads_are_stored_once_and_records_are_whole(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == len({(html or "") for _, _, html in PAGES})
    for row in warc.read_records(spark, archive).collect():
        fields, http, body = warc.parse_record(bytes(row.record))
        assert int(fields["Content-Length"]) == len(http) + 4 + len(body)
        assert body in (b"", bytes(row.payload)) and http.startswith(b"HTTP/1.1 200")
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_changed_bytes_are_found(spark, archive):
    broken = scratch(spark, "broken")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{broken}/headers")
    payloads = spark.read.parquet(f"{archive}/payloads")
    payloads.withColumn("payload", F.concat("payload", F.lit(b"x"))).write.parquet(f"{broken}/payloads")
    with pytest.raises(PySparkException) as error:
        warc.read_archive(spark, broken).collect()
    assert "not a record" in str(error.value) or "does not match" in str(error.value)


def test_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], "page_id long, url string, html string")
    where = scratch(spark, "warc")
    warc.write_archive(pages, where, least=3)
    assert {(r.id, r.record_type, r.refers_to) for r in warc.read_archive(spark, where).collect()} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None),
    }
    where = scratch(spark, "warc")
    warc.write_archive(pages.where("false"), where)
    assert warc.read_archive(spark, where).count() == 0


def test_record_ids_are_unique_and_references_are_checked(spark, archive):
    parsed = [warc.parse_record(bytes(r.record))[0] for r in warc.read_records(spark, archive).collect()]
    ids = [fields["WARC-Record-ID"] for fields in parsed]
    assert len(set(ids)) == len(ids)
    holders = {f["WARC-Record-ID"] for f in parsed if f["WARC-Type"] == "response"}
    assert all(f["WARC-Refers-To"] in holders for f in parsed if f["WARC-Type"] == "revisit")
    assert any(f["WARC-Target-URI"].startswith("http://a.b/0%0D%0AX:%20y") for f in parsed)
    broken = scratch(spark, "broken")
    spark.read.parquet(f"{archive}/payloads").write.parquet(f"{broken}/payloads")
    headers = spark.read.parquet(f"{archive}/headers")
    other = F.when(F.col("record_type") == "revisit", F.lit(12345)).cast("long")
    headers.withColumn("refers_to", other).write.parquet(f"{broken}/headers")
    with pytest.raises(PySparkException, match="does not match"):
        warc.read_archive(spark, broken).collect()


def test_rows_that_repeat_a_page_have_one_response(spark):
    pages = spark.range(50).selectExpr("7 as page_id", "'u' as url", "'same' as html")
    where = scratch(spark, "warc")
    warc.write_archive(pages, where)
    rows = warc.read_archive(spark, where).collect()
    assert sorted((r.record_type, r.refers_to) for r in rows) == [("response", None)] + [("revisit", 7)] * 49
