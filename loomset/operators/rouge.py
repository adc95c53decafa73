"""ROUGE scores of predictions against targets.

ROUGE-1, -2, -L and -Lsum after Lin (2004): lower-case ASCII tokens, no stemming, F1 with equal
weight on precision and recall, 0 when a side is empty. A corpus score is the plain mean, with a
bootstrap interval around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.errors import AlignmentError
from loomset.functions import overlap
from loomset.functions.text import or_empty
from loomset.operators.identity import KEY

METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")
_ORDERS = {"rouge1": 1, "rouge2": 2}
# Resamples of an interval, and how many draws of 16 bits an MD5 gives.
RESAMPLES = 200
_DRAWS = 8
# The distribution of Poisson(1) in parts of 65,536; a draw counts once per value reached.
_POISSON = (24109, 48218, 60273, 64292, 65296, 65497, 65531, 65535)
_PAIR = (KEY, "model")


def pair_up(targets: DataFrame, predictions: DataFrame) -> DataFrame:
    """Put each prediction next to its target: ``(example_id, model, prediction, target)``.

    The merge hint keeps both sides hash-partitioned by key whatever their size, and the
    scores below group by that key, so they need no exchange of their own.
    """
    return (
        targets.select(KEY, "target")
        .join(predictions.select(KEY, "model", "prediction").hint("merge"), KEY)
        .select(KEY, "model", "prediction", "target")
    )


def alignment(targets: DataFrame, predictions: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """Per model: targets without a prediction, predictions without a target, repeated ones."""
    per_key = predictions.groupBy(KEY).agg(
        *[F.count_if(F.col("model") == m).alias(m) for m in models]
    )
    known = targets.groupBy(KEY).agg(F.count("*").alias("_targets"))
    both = known.join(per_key.hint("merge"), KEY, "full_outer")
    target, blank = F.coalesce("_targets", F.lit(0)), F.lit(0)
    checks = [
        F.struct(
            F.lit(m).alias("model"),
            F.count_if((target > 0) & (F.coalesce(m, blank) == 0)).alias("missing"),
            F.count_if((target == 0) & (F.coalesce(m, blank) > 0)).alias("unknown"),
            F.count_if((F.coalesce(m, blank) > 1) | (target > 1)).alias("repeated"),
        )
        for m in models
    ]
    return both.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def require_alignment(
    targets: DataFrame, predictions: DataFrame, models: tuple[str, ...]
) -> None:
    """Fail unless every target has exactly one prediction of every model."""
    for row in alignment(targets, predictions, models).collect():
        if row["missing"] or row["unknown"] or row["repeated"]:
            raise AlignmentError(
                f"Model '{row['model']}': {row['missing']} targets without a prediction, "
                f"{row['unknown']} predictions without a target, {row['repeated']} keys repeated."
            )


def _scored(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from hits and the two lengths."""
    hits, predicted, expected = F.col("hits"), F.col("predicted"), F.col("expected")
    return counts.withColumns(
        {
            "precision": F.when(predicted > 0, hits / predicted).otherwise(F.lit(0.0)),
            "recall": F.when(expected > 0, hits / expected).otherwise(F.lit(0.0)),
            "f1": overlap.f_score(hits, predicted, expected),
        }
    )


def ngram_scores(pairs: DataFrame, metrics: tuple[str, ...] = tuple(_ORDERS)) -> DataFrame:
    """ROUGE-N per key, model and metric.

    A key that has one row of each model is counted within its rows, so a task holds a few counts
    per row and no n-gram. Rows that repeat a key and model count as one text: theirs go out as one
    row per n-gram, tagged with the side it comes from, grouped once to compare the two counts and
    once to add them up. No join, and no exchange or sort when the pairs are already partitioned
    and sorted by key.
    """
    of_key = Window.partitionBy(KEY)
    tokens = pairs.select(
        *_PAIR, "prediction", "target",
        (F.size(F.collect_set("model").over(of_key)) == F.count("*").over(of_key)).alias("alone"),
    ).select(
        *_PAIR,
        "alone",
        overlap.score_tokens(or_empty(F.col("prediction"))).alias("p"),
        overlap.score_tokens(or_empty(F.col("target"))).alias("t"),
    )

    def part(order: int, hits: Column, p: Column, t: Column, grams: Column) -> Column:
        numbers = {"hits": hits, "p": p, "t": t}
        return F.struct(
            F.lit(order).alias("n"), *[x.cast("long").alias(name) for name, x in numbers.items()], grams.alias("grams")
        )

    none = F.lit(None)
    counted, sides = [], []
    for order in (_ORDERS[metric] for metric in metrics):
        grams = [F.col(side) if order == 1 else overlap.bigrams(F.col(side)) for side in "pt"]
        sizes = [F.greatest(F.size(side) - (order - 1), F.lit(0)) for side in "pt"]
        counted.append(part(order, overlap.common_count(*grams), *sizes, none.cast("array<string>")))
        sides += [part(order, none, F.lit(1 - t), F.lit(t), grams[t]) for t in (0, 1)]
    # A side without n-grams gives one null gram, which counts nothing but keeps the pair.
    grams = tokens.select(
        *_PAIR, F.inline(F.when(F.col("alone"), F.array(*counted)).otherwise(F.array(*sides)))
    ).select(*_PAIR, "n", "hits", "p", "t", F.explode_outer("grams").alias("gram"))
    counts = F.col("gram").isNotNull() | F.col("hits").isNotNull()
    summed = grams.groupBy(*_PAIR, "n", "gram").agg(
        F.sum("hits").alias("hits"), *[F.sum(F.when(counts, F.col(s)).otherwise(0)).alias(s) for s in "pt"]
    )
    names = F.create_map(*[F.lit(x) for m in metrics for x in (_ORDERS[m], m)])
    totals = (
        summed.groupBy(*_PAIR, "n")
        .agg(
            F.sum(F.coalesce("hits", F.least("p", "t"))).alias("hits"),
            F.sum("p").alias("predicted"),
            F.sum("t").alias("expected"),
        )
        .select(*_PAIR, names[F.col("n")].alias("metric"), "hits", "predicted", "expected")
    )
    return _scored(totals)


def lcs_scores(pairs: DataFrame) -> DataFrame:
    """ROUGE-L per pair, with the longest common subsequence found in an Arrow helper."""
    hits = overlap.lcs_length(
        overlap.score_text(or_empty(F.col("prediction"))),
        overlap.score_text(or_empty(F.col("target"))),
    )
    return _row_scores(pairs, "rougeL", hits)


def summary_scores(pairs: DataFrame) -> DataFrame:
    """ROUGE-Lsum per pair; each line is a sentence."""
    hits = overlap.summary_hits(
        overlap.score_text(or_empty(F.col("prediction")), keep_lines=True),
        overlap.score_text(or_empty(F.col("target")), keep_lines=True),
    )
    return _row_scores(pairs, "rougeLsum", hits)


def _row_scores(pairs: DataFrame, metric: str, hits: Column) -> DataFrame:
    def length(side: str) -> Column:
        return F.size(overlap.score_tokens(or_empty(F.col(side)))).cast("long")

    return _scored(
        pairs.select(
            *_PAIR,
            F.lit(metric).alias("metric"),
            hits.cast("long").alias("hits"),
            length("prediction").alias("predicted"),
            length("target").alias("expected"),
        )
    )


def rouge_scores(pairs: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """All wanted metrics, one row per pair and metric.

    ROUGE-N alone adds up rows that repeat key and model. With a subsequence metric each row is
    scored by itself: one helper counts all its metrics, and no n-gram is shuffled.
    """
    if set(metrics) <= set(_ORDERS):
        return ngram_scores(pairs, metrics)
    texts = [overlap.score_text(or_empty(F.col(side)), keep_lines=True) for side in ("prediction", "target")]
    counted = pairs.select(*_PAIR, overlap.all_hits(*texts, metrics).alias("counts"))

    def row(metric: str) -> Column:
        shorter = _ORDERS.get(metric, 1) - 1
        sizes = [F.greatest(F.col(f"counts.{s}") - shorter, F.lit(0)).cast("long").alias(s) for s in ("predicted", "expected")]
        return F.struct(F.lit(metric).alias("metric"), F.col(f"counts.{metric}").alias("hits"), *sizes)

    return _scored(counted.select(*_PAIR, F.inline(F.array(*map(row, metrics)))))


def corpus_scores(scores: DataFrame) -> DataFrame:
    """Mean F1 per model and metric."""
    return scores.groupBy("model", "metric").agg(F.avg("f1").alias("value"))


def resampled_scores(scores: DataFrame, resamples: int = RESAMPLES) -> DataFrame:
    """``(model, metric, draw, value)``: the plain mean as draw 0 and a mean per bootstrap resample.

    A row takes part in a resample as often as a Poisson(1) variable says, which is read off the MD5 of
    the resample and the row's key. So no row is copied or shuffled for it, both models and all metrics
    see the same resamples, and reruns agree. A resample without any row has no value.
    """
    blocks = F.sequence(F.lit(0), F.lit(max(0, -(-resamples // _DRAWS) - 1)))
    digests = scores.select(
        "model", "metric", "f1",
        F.transform(blocks, lambda k: F.md5(F.concat(k.cast("string"), F.lit(":"), F.col(KEY).cast("string")))).alias("digests"),
    )

    def times(draw: Column) -> Column:
        digest = F.element_at("digests", F.floor((draw - 1) / _DRAWS).cast("int") + 1)
        place = F.conv(F.substr(digest, (draw - 1) % _DRAWS * 4 + 1, F.lit(4)), 16, 10).cast("int")
        return sum((F.when(place >= least, 1).otherwise(0) for least in _POISSON[1:]), F.when(place >= _POISSON[0], 1).otherwise(0))

    draws = F.sequence(F.lit(0), F.lit(resamples))
    taken = digests.select(
        "model", "metric", "f1",
        F.explode(F.transform(draws, lambda d: F.struct(d.alias("draw"), F.when(d == 0, 1).otherwise(times(d)).alias("times")))).alias("d"),
    ).where("d.times > 0")
    weight = F.col("d.times")
    return taken.groupBy("model", "metric", F.col("d.draw").alias("draw")).agg(
        (F.sum(F.col("f1") * weight) / F.sum(weight)).alias("value")
    )


def corpus_intervals(resampled: DataFrame, level: float = 0.95) -> DataFrame:
    """Mean score with the percentiles of the resamples around it: low, mid, high."""
    edges = [(1 - level) / 2, 0.5, (1 + level) / 2]
    found = resampled.groupBy("model", "metric").agg(
        F.max(F.when(F.col("draw") == 0, F.col("value"))).alias("value"),
        F.percentile(F.when(F.col("draw") > 0, F.col("value")), F.array(*map(F.lit, edges))).alias("cuts"),
    )
    cuts = [F.get("cuts", F.lit(i)).alias(name) for i, name in enumerate(("low", "mid", "high"))]
    return found.select("model", "metric", "value", *cuts)
