import regex
from pyspark.sql import functions as F

from loomset.functions.tokens import first_tokens, token_count, without_markers

TOKEN = regex.compile(r"<\|[a-z_]+\|>|[\p{L}\p{N}_]+|[^\p{L}\p{N}_\x09-\x0d\x20]")
TEXTS = [
    "",
    "  \n ",
    "one",
    "one, two",
    "<|im_start|>user\nhi<|im_end|>",
    "<|not closed",
    "snake_case x2 ñandú 漢字",
    " lead and trail  ",
    "a\xa0b　c",
    "é́ combining",
    "tabs\tand\x0bmore",
    "word " * 3000,
]


def test_count_equals_regex_library(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r.n for r in frame.select(token_count(F.col("t")).alias("n")).collect()]
    assert got == [len(TOKEN.findall(t)) for t in TEXTS]


def test_marker_counts_once(spark):
    frame = spark.createDataFrame([("<|im_end|>",)], "t string")
    assert frame.select(token_count(F.col("t")).alias("n")).first().n == 1


def test_first_tokens_is_a_prefix_ending_at_a_token(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for limit in (1, 2, 5, 2048):
        got = [r.p for r in frame.select(first_tokens(F.col("t"), limit).alias("p")).collect()]
        for text, prefix in zip(TEXTS, got):
            ends = [m.end() for m in TOKEN.finditer(text)]
            assert prefix == (text if len(ends) <= limit else text[: ends[limit - 1]])


def test_long_text_does_not_exhaust_the_stack(spark):
    text = "x" * 200_000 + " , " * 100_000
    frame = spark.createDataFrame([(text,)], "t string")
    row = frame.select(
        token_count(F.col("t")).alias("n"), F.length(first_tokens(F.col("t"), 50_000)).alias("m")
    ).first()
    assert row.n == 100_001
    assert row.m == 200_000 + 3 * 49_999 - 1


def test_markers_removed(spark):
    frame = spark.createDataFrame([("a<|end|> b<|im_end|><|X|>",)], "t string")
    assert frame.select(without_markers(F.col("t")).alias("t")).first().t == "a b<|X|>"
