import pytest


@pytest.fixture
def documents(spark):
    """Rows of ``documents`` from tuples (doc_id, text, lang, source), with clashing extra columns."""

    def build(*rows):
        padded = [(*row, *("en", "src")[len(row) - 2 :], 0, "kept", 1) for row in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars int, kept string, size int"
        return spark.createDataFrame(padded, schema)

    return build


#: Nulls, empties, white space, repeats, non-ASCII signs and one long text.
ODD_TEXTS = (
    None, "", " \t\n", "a", "a", "Ärger im Büro, GROSS!!", "naïve café — 日本語 😀", "x y z " * 4, "word " * 30_000,
    "no break \x1c\x85 lines\nno break \x1c\x85 lines\n", "idiot you are", "<|endoftext|> it's I'LL 'S",
)

#: Very long texts without a break.
UNBROKEN_TEXTS = ("a" * 1_000_000, "7" * 1_000_000, "a-" * 500_000, "a1" * 500_000, "a" + "-" * 1_000_000, "a b " * 250_000)
