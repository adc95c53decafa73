"""Text expressions on raw instruction rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java regex character class. The range in front of the rarer characters lets
# ordinary ones fail after one comparison.
WHITESPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0[\x{1680}-\x{3000}"
    r"&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
# Fixed value: the line between an instruction and its context.
CONTEXT_HEADING = "\n\nContext:\n"


def or_empty(value: Column) -> Column:
    """Null counts as the empty string."""
    return F.coalesce(value, F.lit(""))


def strip(value: Column) -> Column:
    """Both-sided strip with Python's notion of whitespace (``F.trim`` alone drops only spaces)."""
    return F.btrim(value, F.lit(WHITESPACE))


def user_turn(instruction: Column, context: Column) -> Column:
    """The instruction, followed by the context unless that is blank."""
    asked = strip(or_empty(instruction))
    given = strip(or_empty(context))
    return F.when(given != "", F.concat(asked, F.lit(CONTEXT_HEADING), given)).otherwise(asked)


def answer(response: Column, output: Column) -> Column:
    """The response, or ``output`` where the response is null or empty.

    The choice is made before stripping, so a response of blanks alone does not fall back.
    """
    return strip(F.coalesce(F.nullif(response, F.lit("")), output, F.lit("")))


def word_count(value: Column) -> Column:
    """Number of whitespace-separated words.

    Splitting on runs of whitespace is several times faster on the JVM than matching
    the complement of the class.
    """
    bare = strip(or_empty(value))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WHITESPACE_CLASS + "++")))


def fused_word_count(*fields: Column) -> Column:
    """Words of the fields joined with nothing in between, so words fuse at the joins."""
    return word_count(F.concat(*[or_empty(field) for field in fields]))
