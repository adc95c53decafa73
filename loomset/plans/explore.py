"""Explore job: size, word lengths and one formatted row of a raw table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.functions.chat import ChatTemplate
from loomset.operators.formatting import format_rows
from loomset.operators.identity import KEY, content_key
from loomset.operators.profiling import SAMPLE_ROWS, length_profile, preview
from loomset.params import SYSTEM_PROMPT


@dataclass(frozen=True)
class Profile:
    rows: int
    word_lengths: DataFrame
    preview: DataFrame


def explore(
    rows: DataFrame,
    key: str | None = None,
    sample: int | None = SAMPLE_ROWS,
    system_prompt: str = SYSTEM_PROMPT,
    template: ChatTemplate | None = None,
) -> Profile:
    """Look at ``sample`` rows (None: all); fewer rows than that is not an error.

    Nothing is written: without a key, rows are ordered by the hash of their content, and which of
    several equal rows is looked at does not show.
    """
    keyed = rows.withColumn(KEY, F.col(key) if key else content_key(rows))
    return Profile(
        rows.count(),
        length_profile(keyed, sample),
        preview(format_rows(keyed, system_prompt, template)),
    )
