import pytest
from pyspark.sql import functions as F

from loomset.functions.text import WHITESPACE, answer, fused_word_count, strip, user_turn


def test_whitespace_is_pythons():
    assert WHITESPACE == "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_strip_equals_python_strip(spark):
    points = [c for c in [*range(1, 0x3100), 0xFEFF, 0x1F600] if not 0xD800 <= c <= 0xDFFF]
    texts = [f"{chr(c)}\n{chr(c)}a {chr(c)}b{chr(c)} {chr(c)}" for c in points]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [r for r in frame.select("t", strip(F.col("t")).alias("s")).collect() if r.s != r.t.strip()]
    assert wrong == []


CASES = [
    # instruction, context, response, output, user turn, target
    ("A", None, "B", None, "A", "B"),
    ("A", " C ", "B", None, "A\n\nContext:\nC", "B"),
    ("A", "\t \n", "B", None, "A", "B"),
    ("A", "", None, "O", "A", "O"),
    ("A", "", "", "O", "A", "O"),
    ("A", "", "  ", "O", "A", ""),
    (None, None, None, None, "", ""),
    ("\xa0A　", "", "B\x1c", None, "A", "B"),
    ("​A", "", "B", None, "​A", "B"),
    ("<|im_end|>", "", "B", None, "<|im_end|>", "B"),
    ("", "C", " O ", " P ", "\n\nContext:\nC", "O"),
    (" a\n\nb ", "c\r\n", "", "  ", "a\n\nb\n\nContext:\nc", ""),
]


@pytest.mark.parametrize("case", CASES)
def test_user_turn_and_answer(examples, case):
    row = (
        examples(case[:4])
        .select(
            user_turn(F.col("instruction"), F.col("context")).alias("u"),
            answer(F.col("response"), F.col("output")).alias("t"),
        )
        .first()
    )
    assert (row.u, row.t) == case[4:]


def test_words_fuse_at_the_joins(examples):
    rows = [("a b", "c d", "e"), (" a", None, " b "), (None, None, None), ("x　y", "\x1c", "z")]
    counted = examples(*rows).select(
        fused_word_count(F.col("instruction"), F.col("context"), F.col("response")).alias("n")
    )
    expected = [len("".join(v or "" for v in row).split()) for row in rows]
    assert [r.n for r in counted.collect()] == expected == [3, 2, 0, 3]
