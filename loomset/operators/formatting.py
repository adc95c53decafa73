"""From instruction rows to formatted, measured rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import chat
from loomset.functions.text import answer, user_turn
from loomset.functions.tokens import token_count

HELPERS = ("num_tokens", "within_limit")


def format_rows(
    rows: DataFrame, system_prompt: str, template: chat.ChatTemplate | None = None
) -> DataFrame:
    """Add ``text``, ``prompt`` and ``target``; other columns stay as they are.

    Without a template the generic ChatML layout is used. One template holds for a whole run.
    """
    user = user_turn(F.col("instruction"), F.col("context"))
    reply = answer(F.col("response"), F.col("output"))
    if template is None:
        prompt = chat.chatml_prompt(system_prompt, user)
        text = chat.chatml_text(prompt, reply)
    else:
        prompt = chat.render(chat.prompt_messages(system_prompt, user), template, ask=True)
        text = chat.render(chat.full_messages(system_prompt, user, reply), template, ask=False)
    return rows.withColumns({"text": text, "prompt": prompt, "target": reply})


def measure_rows(
    rows: DataFrame, max_tokens: int, counter: Callable[[Column], Column] = token_count
) -> DataFrame:
    """Add ``num_tokens`` of ``text`` and whether it is within the limit (equal counts as within)."""
    measured = rows.withColumn("num_tokens", counter(F.col("text")).cast("int"))
    within = F.col("num_tokens") <= F.lit(max_tokens)
    if counter is token_count:
        # Such a token has a character at least, so where only the flag is used, a text with no
        # more characters than allowed tokens is not matched at all.
        within = (F.length("text") <= F.lit(max_tokens)) | within
    return measured.withColumn("within_limit", within)


def drop_long_rows(rows: DataFrame) -> DataFrame:
    """Drop, not truncate, rows over the limit, and the helper columns with them."""
    return rows.where(F.col("within_limit")).drop(*HELPERS)
