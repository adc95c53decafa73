"""Mixing sources to target weights, in DataFrame operations only.

Each source gets a budget of words. Its documents are put into a hash-random order, a distributed
prefix sum runs over their sizes, and the mix takes whole rounds over the source plus the documents
before the point where the budget is spent; the document at that point is taken in part, so the
budget is met to the word.

Defined results: a null text has size 0; a null source is a source of its own and comes last; a
source without words has target 0; equal rows get equal keys and any order among them gives the
same rows; an empty table gives an empty table. Columns of the input are kept unless they bear the
name of an output column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import SPACE, word_count

WEIGHTS = (3, 1, 2)
#: Hex digits of the random key that name a cell. A source's keys are uniform, so its cells are
#: ranges of equal size that need no sampling: 16**3 tasks can share one hot source.
CELL_DIGITS = 3
_ROW, _KEY, _SIZE, _CELL, _GROUP = "__mix_row", "__mix_key", "__mix_size", "__mix_cell", "__mix_source"


def source_targets(totals: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``(group, source_size, target)``: fill sources by weight until each has its cap or the level.

    With caps ordered by cap/weight, the level is the first one that its own source can bear;
    later ones are lower, since they charge caps that are not reached. The input has a row per
    source, so the windows without a partition see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col(_GROUP).getField("missing"), F.col(_GROUP).getField("name"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    cap = F.col("source_size") * most
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("turn"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    return (
        totals.select(
            _GROUP,
            "source_size",
            turn.alias("turn"),
            weight.alias("weight"),
            cap.alias("cap"),
            (F.sum("source_size").over(everything) * share).alias("budget"),
        )
        .withColumn("level", level)
        .withColumn(
            "level",
            F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(
                everything
            ),
        )
        .select(
            _GROUP,
            "source_size",
            F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes, with repeats).

    Sources share ``share`` times the words of all, by ``weights`` in turn, at most ``most`` times
    each source's own words. One exchange carries the rows, dealt by source and key range.
    """
    size = word_count(F.col("text")) if size is None else size
    random = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("-"))))
    group = F.struct(
        F.col(source).isNull().alias("missing"),
        F.coalesce(F.col(source), F.lit("")).alias("name"),
    )
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias(_ROW),
        group.alias(_GROUP),
        size.alias(_SIZE),
        random.alias(_KEY),
        F.substring(random, 1, CELL_DIGITS).alias(_CELL),
    )
    cells = (
        rows.groupBy(_GROUP, _CELL)
        .agg(F.sum(_SIZE).alias("cell_size"))
        .withColumn(
            "before",
            F.sum("cell_size").over(Window.partitionBy(_GROUP).orderBy(_CELL)) - F.col("cell_size"),
        )
    )
    totals = cells.groupBy(_GROUP).agg(F.sum("cell_size").alias("source_size"))
    plan = cells.join(source_targets(totals, weights, share, most), _GROUP).drop("cell_size")
    in_cell = Window.partitionBy(_GROUP, _CELL).orderBy(_KEY, _SIZE)
    running = rows.withColumn(
        "upto", F.sum(_SIZE).over(in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    budget = F.floor(F.col("target") + 0.5)
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - rounds * F.col("source_size")
    start = F.col("before") + F.col("upto") - F.col(_SIZE)
    part = F.greatest(F.lit(0), F.least(F.col(_SIZE), left - start))
    made = ("size", "source_size", "target", "taken")
    return running.join(plan, [_GROUP, _CELL]).select(
        *(F.col(_ROW)[c].alias(c) for c in docs.columns if c.lower() not in made),
        F.col(_SIZE).alias("size"),
        F.col("source_size"),
        F.col("target"),
        (rounds * F.col(_SIZE) + part).cast("long").alias("taken"),
    )


def materialise(mixed: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """The mix itself: a row per round and document, and the cut document with its first words.

    Documents of which nothing is taken are absent; a document without words is never taken.
    """
    rounds = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    rest = F.col("taken") - rounds * F.col("size")
    words = F.filter(F.split(F.col(text), SPACE), lambda word: word != "")
    begin = F.array_join(F.slice(words, F.lit(1), F.greatest(rest, F.lit(1)).cast("int")), " ")
    whole = F.transform(F.sequence(F.lit(1), rounds), lambda _: F.col(text))
    texts = F.concat(
        F.when(rounds > 0, whole).otherwise(F.array().cast("array<string>")),
        F.when(rest > 0, F.array(begin)).otherwise(F.array().cast("array<string>")),
    )
    out = mixed.withColumn("__mix_text", F.explode(texts))
    return out.select(*(F.col("__mix_text").alias(c) if c == text else out[f"`{c}`"] for c in columns))
