"""Token counting and truncation with a vocabulary-free tokenizer.

A token is a ``<|marker|>``, a run of letters, digits and underscores, or one other visible
character. A caller with a real vocabulary passes its own counter to ``operators.formatting``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKER_PATTERN = r"<\|[a-z_]+\|>"
_SPACE = r"\x09-\x0d\x20"
# Possessive runs: a token never gives characters back, so no backtracking on long words.
TOKEN_PATTERN = rf"[\p{{L}}\p{{N}}_]++|<\|[a-z_]++\|>|[^\p{{L}}\p{{N}}_{_SPACE}]"


def token_count(text: Column) -> Column:
    """Number of tokens of the whole text."""
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def first_tokens(text: Column, limit: int) -> Column:
    """The text up to the end of its ``limit``-th token, spacing kept."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[{_SPACE}]*+(?:{TOKEN_PATTERN})"), F.lit(0))
    # A token has at least one character, so most texts are known to fit without matching.
    fits = (F.length(text) <= limit) | (token_count(text) <= limit)
    return F.when(fits, text).otherwise(F.array_join(F.slice(pieces, 1, limit), ""))


def without_markers(text: Column) -> Column:
    """The text with special markers removed."""
    return F.regexp_replace(text, MARKER_PATTERN, "")
