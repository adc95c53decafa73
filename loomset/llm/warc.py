"""A content-addressed WARC archive.

Payload bytes are stored once, by SHA-256, and exact record headers apart from them; a record is
put together again by a join. A page whose payload another page already has becomes a revisit that
names the page that holds it. Both tables are Parquet below one location.

Reading back verifies everything: payloads against the strong digest that they are stored by and
the length beside it, and each record's header block against the SHA-1, the length, its own id and
the record that it refers to.

Defined results: a null payload is empty; of equal payloads the largest id is the response and
null ids are smallest; rows that repeat id and payload are one response and revisits to the same
id; payloads under ``least`` bytes are all responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.common import stored, text_bytes

# The format's line break, version line and revisit profile.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
DATE = "1970-01-01T00:00:00Z"


_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_DIGESTED = "id long, place long, uri binary, payload_bytes long, payload_digest string, address binary"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length, SHA-1 (base32) and SHA-256 of payloads; blanks and control signs of addresses escaped."""
    for batch in batches:
        sha1, sha256, size, uri = [], [], [], []
        for payload, url in zip(batch.column("payload"), batch.column("url")):
            data = payload.as_buffer()
            sha1.append(base64.b32encode(hashlib.sha1(data).digest()).decode())
            sha256.append(hashlib.sha256(data).digest())
            size.append(data.size)
            raw = url.as_buffer().to_pybytes() if url.is_valid else b""
            uri.append(_UNSAFE.sub(lambda sign: b"%%%02X" % sign[0][0], raw))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("place"), pa.array(uri, pa.binary()),
                pa.array(size, pa.int64()), pa.array(sha1, pa.string()), pa.array(sha256, pa.binary()),
            ],
            names=["id", "place", "uri", "payload_bytes", "payload_digest", "address"],
        )


def record_name(key: int | None, address: bytes, place: int | None = None) -> str:
    """A name-based record id. The record that holds a payload is named by page and payload, any other
    also by its row's place in the input, so that no two records share an id."""
    name = f"page:{'' if key is None else key}:{address.hex()}:{'' if place is None else place}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(name.encode()).digest())}>"


def _record_id(key: Column, address: Column, place: Column) -> Column:
    """:func:`record_name` as a column."""
    parts = [F.lit("page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.lower(F.hex(address)), F.lit(":"), F.coalesce(place.cast("string"), F.lit(""))]
    digest = F.md5(F.concat(*parts))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header_block() -> Column:
    """The record's header lines, each ended by a line break, and the HTTP head of its block."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(HTTP_HEAD), F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF)
    )
    length = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    own = F.when(~F.col("at_holder"), F.col("place"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"), F.col("address"), own)),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri").cast("string")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("holder.id"), F.col("address"), F.lit(None)))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), http)


def write_archive(pages: DataFrame, location: str, least: int = 0, key: str = "page_id", payload: str = "html") -> None:
    """Store ``payloads`` (address, bytes once) and ``headers`` (one per page) below ``location``.

    One aggregate finds the bytes of each payload, another, on rows without payloads, the row that holds
    it: of its copies the one with the largest id, then address of the page, then place in the input.
    Copies within an input partition meet before any row moves. Headers then take the holder by a narrow
    join. Its key repeats on one side only, both sides are read from storage and nothing after it needs
    their partitioning, so adaptive execution may split a payload that a third of all pages share.
    """
    spark = pages.sparkSession
    source = pages.select(
        F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("place"),
        F.col("url").cast("string").alias("url"), text_bytes(F.col(payload)).alias("payload"),
    )
    digested = stored(source.mapInArrow(_digests, _DIGESTED), "digested-pages")
    payloads = source.select(F.unhex(F.sha2("payload", 256)).alias("address"), "payload")
    payloads.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(f"{location}/payloads")
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "uri", "place")
    holders = stored(digested.groupBy("address").agg(F.max(order).alias("holder")), "payload-holders")
    joined = digested.join(holders, "address")
    at_holder = F.col("place") == F.col("holder.place")
    small = F.col("payload_bytes") < least
    typed = joined.withColumn("at_holder", at_holder).withColumn(
        "record_type", F.when(small | at_holder, "response").otherwise("revisit")
    )
    typed.select(
        "id", "address",
        F.when(~F.col("at_holder"), F.col("place")).alias("place"),
        F.encode(_header_block(), "UTF-8").alias("header"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("holder.id")).alias("refers_to"),
    ).write.parquet(f"{location}/headers")


def read_records(spark: SparkSession, location: str) -> DataFrame:
    """Every page's record, whole: header block, its payload, and the closing line breaks.

    ``record`` holds the bytes as they would lie in an archive file (no payload in a revisit);
    ``payload`` is the page's payload in either case.
    """
    headers = spark.read.parquet(f"{location}/headers")
    payloads = spark.read.parquet(f"{location}/payloads")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return headers.join(payloads, "address").select(
        "id", "address", "place", "refers_to", "payload",
        F.concat(F.col("header"), body, F.lit(b"\r\n\r\n")).alias("record"),
    )


PARSED = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_PARSED_ARROW = pa.schema(
    [("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP head and payload of one record; ValueError if it is not well formed."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split(CRLF)
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if first != VERSION or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a record of this archive")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        narrow = (batch.column(c).to_pylist() for c in ("id", "address", "place", "refers_to"))
        for key, address, place, refers, payload, record in zip(*narrow, batch.column("payload"), batch.column("record")):
            data = payload.as_py()
            fields, http, body = parse_record(record.as_py())
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            kind = fields["WARC-Type"]
            stated = http.rpartition(b"Content-Length: ")[2]
            holder = record_name(refers, address) if kind == "revisit" else None
            if (
                hashlib.sha256(data).digest() != address
                or fields["WARC-Record-ID"] != record_name(key, address, place)
                or fields.get("WARC-Refers-To") != holder
                or fields["WARC-Payload-Digest"] != f"sha1:{digest}"
                or int(stated) != len(data)
                or body != (data if kind == "response" else b"")
            ):
                raise ValueError(f"record of page {key} does not match its payload")
            out.append((key, len(data), digest, kind, refers))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*out), _PARSED_ARROW)] if out else [pa.array([], f.type) for f in _PARSED_ARROW],
            schema=_PARSED_ARROW,
        )


def read_archive(spark: SparkSession, location: str) -> DataFrame:
    """Parse and verify every record: id, payload length and digest, type, and what it refers to."""
    return read_records(spark, location).mapInArrow(_verified, PARSED)
