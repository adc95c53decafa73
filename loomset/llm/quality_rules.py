"""Quality rules with cutoffs that are certified on labelled holdouts.

A document is described by counts over its whole text; each rule compares a per-mille rate with a
cutoff. Which cutoffs hold is decided per stratum from labelled rows. One half of them (``plan``)
orders steps: each step lowers one rule's cutoff where that rejects most bad rows for the good rows
it costs. The other half (``holdout``) certifies them: the steps are nested, so they are tested one
after the other with the exact binomial tail of the good rows rejected so far, and testing stops at
the first step whose false rejection is not shown to stay under the limit. Such a fixed sequence needs
no correction among its steps; the strata share the error probability by Holm's rule. So with
probability ``1 - alpha`` no stratum's cutoffs reject more than ``limit`` of its good rows.

Defined results: a null text has no words and fails the base rule; a null stratum is a stratum of its
own; a stratum without enough labels keeps all rows that pass the base rule; copies of a labelled text
are one labelled text with their lowest label; repeated rows get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import stored

WINDOW = 8
LIMIT = 0.02
ALPHA = 0.05
#: Cutoffs of each rule, in per mille, loose to strict. Rows are rejected above a cutoff.
CUTOFFS = (500, 300, 200, 100, 50, 20)
# The rules and their numerator and denominator.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "copied_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "n_letters"),
    "shouts": ("n_shouts", "n_words"),
    "stutter": ("n_stutters", "n_words"),
}
#: Strata whose cutoffs are sent to all tasks; with more of them the cutoffs are joined by a shuffle.
BROADCAST_STRATA = 10_000

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_letters", "n_shouts", "n_stutters",
)
# The signs that count as symbols, and ASCII white space.
_SYMBOLS, _BLANKS = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more; ids stand for words."""
    starts = len(ids) - window + 1
    if starts < 2:
        return 0
    mixed = np.zeros(starts, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + starts].astype(np.uint64) + np.uint64(1)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    # Equal mixes are compared word by word, so the count is exact.
    a, b = order[:-1][same], order[1:][same]
    for k in range(window):
        if (ids[a + k] != ids[b + k]).any():
            return _repeated_exactly(ids, window)
    hit = np.zeros(starts, bool)
    hit[a] = hit[b] = True
    return _covered(hit, window)


def _covered(hit: np.ndarray, window: int) -> int:
    edge = np.zeros(len(hit) + window + 1, np.int64)
    edge[np.flatnonzero(hit)] += 1
    edge[np.flatnonzero(hit) + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _repeated_exactly(ids: np.ndarray, window: int) -> int:
    found: dict[bytes, list[int]] = {}
    for at in range(len(ids) - window + 1):
        found.setdefault(ids[at : at + window].tobytes(), []).append(at)
    hit = np.zeros(len(ids) - window + 1, bool)
    for places in found.values():
        if len(places) > 1:
            hit[places] = True
    return _covered(hit, window)


def count(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANKS)]
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    small = len(raw) - len(raw.translate(None, _LOWER))
    blanks = len(raw) - len(raw.translate(None, _BLANKS))
    return (
        len(words),
        len(text or "") - blanks,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        capitals,
        capitals + small,
        raw.count(b"!"),
        int((ids[1:] == ids[:-1]).sum()),
    )


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [count(text) for text in batch.column("__text").to_pylist()]
        table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
        names = [n for n in batch.schema.names if n != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), *(pa.array(c) for c in table.T)], names=[*names, *COUNTS]
        )


def measure(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every document, its counts, and the level each rule reaches.

    A rule's level is the number of its cutoffs that the document's rate exceeds.
    """
    rows = docs.select(*columns, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    counted = rows.mapInArrow(_count_rows, schema)
    levels = []
    for rule, (top, bottom) in RULES.items():
        over = [(F.col(top) * 1000 > F.col(bottom) * cutoff).cast("int") for cutoff in CUTOFFS]
        levels.append(sum(over[1:], over[0]).alias(f"level_{rule}"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *levels)


def tail(errors: int, n: int, rate: float) -> float:
    """Probability of at most ``errors`` in ``n`` draws at ``rate``, exactly."""
    if n == 0:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate)
        for k in range(errors + 1)
    ]
    return min(1.0, sum(map(math.exp, logs)))


def plan_steps(levels: np.ndarray, bad: np.ndarray, weight: np.ndarray) -> list[tuple[int, ...]]:
    """Nested cutoff vectors, loose to strict, from rows of one stratum's planning half.

    A vector has a level per rule from which on rows are rejected; beyond the last level means never.
    Each step takes the cutoff that rejects most bad weight per good weight lost, and stops once none
    rejects more bad than good.
    """
    now = [len(CUTOFFS) + 1] * levels.shape[1]
    out = np.zeros(len(levels), bool)
    steps = []
    while True:
        best = None
        for rule in range(len(now)):
            for level in range(1, now[rule]):
                new = (levels[:, rule] >= level) & ~out
                gain, loss = weight[new & bad].sum(), weight[new & ~bad].sum()
                if gain > loss and (best is None or (gain / (loss + 1), gain, level) > best[0]):
                    best = ((gain / (loss + 1), gain, level), rule, level)
        if best is None:
            return steps
        _, rule, level = best
        now[rule] = level
        out |= levels[:, rule] >= level
        steps.append(tuple(now))


def certify(steps: list[tuple[int, ...]], levels: np.ndarray, weight: np.ndarray, limit: float) -> list[float]:
    """p-value of each step in turn on the good rows of the holdout half: is the limit exceeded?"""
    n = int(weight.sum())
    values = []
    for step in steps:
        out = (levels >= np.array(step)).any(1)
        values.append(tail(int(weight[out].sum()), n, limit))
    return values


def holm(values: dict[object, list[float]], alpha: float) -> dict[object, int]:
    """How many steps of each stratum's sequence hold, with error ``alpha`` over all strata.

    Holm's rule over sequences: strata are tested at alpha over the number of those still unfinished;
    a stratum whose whole sequence passes hands its share on to the others.
    """
    passed = dict.fromkeys(values, 0)
    open_strata = {s for s, v in values.items() if v}
    while open_strata:
        share = alpha / len(open_strata)
        done = set()
        for stratum in open_strata:
            own = values[stratum]
            while passed[stratum] < len(own) and own[passed[stratum]] <= share:
                passed[stratum] += 1
            if passed[stratum] == len(own):
                done.add(stratum)
        if not done:
            break
        open_strata -= done
    return passed


def choose_cutoffs(labelled: DataFrame, limit: float = LIMIT, alpha: float = ALPHA) -> list[tuple[str | None, list[int]]]:
    """Certified cutoff levels per stratum. ``labelled``: stratum, good, plan half, levels.

    Rows that fail the base rule play no part. Per stratum and label there are at most
    ``(len(CUTOFFS) + 1) ** len(RULES)`` different vectors, whatever the input.
    """
    names = [f"level_{rule}" for rule in RULES]
    table = labelled.groupBy("stratum", "good", "planning", *names).agg(F.count("*").alias("n")).toPandas()
    table["stratum"] = [s if isinstance(s, str) else None for s in table["stratum"]]
    plans, values = {}, {}
    for stratum in sorted(set(table["stratum"]), key=lambda s: (s is None, s or "")):
        own = table[[s == stratum for s in table["stratum"]]]
        fit, test = own[own.planning], own[~own.planning & own.good]
        plans[stratum] = plan_steps(fit[names].to_numpy(), ~fit.good.to_numpy(), fit.n.to_numpy())
        values[stratum] = certify(plans[stratum], test[names].to_numpy(), test.n.to_numpy(), limit)
    held = holm(values, alpha)
    never = [len(CUTOFFS) + 1] * len(names)
    return [(s, list(plan[held[s] - 1]) if held[s] else never) for s, plan in plans.items()]


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", limit: float = LIMIT, alpha: float = ALPHA) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every document; ``labels`` has the key and ``quality``."""
    spark = docs.sparkSession
    rows = docs.select(key, F.col(stratum).alias("stratum"), "text", F.xxhash64("text").alias("text_hash"))
    measured = stored(measure(rows, [key, "stratum", "text_hash"]), "quality-counts")
    quality = labels.where("quality is not null").groupBy(F.col(key).alias("__key")).agg(F.min("quality").alias("quality"))
    labelled = (
        measured.where("not base_failed").join(quality, F.col(key) == F.col("__key"))
        # Copies are one draw: they lie in one half and count once, as their worst label says.
        .groupBy("text_hash")
        .agg(
            F.min("stratum").alias("stratum"), (F.min("quality") == 1).alias("good"),
            *[F.first(f"level_{rule}").alias(f"level_{rule}") for rule in RULES],
        )
        .withColumn("planning", F.pmod(F.xxhash64("text_hash", F.lit("half")), F.lit(2)) == 0)
    )
    chosen = choose_cutoffs(labelled, limit, alpha)
    cutoffs = spark.createDataFrame([(s, list(map(int, c))) for s, c in chosen], "cut_stratum string, cuts array<int>")
    if len(chosen) <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    judged = measured.join(cutoffs, measured["stratum"].eqNullSafe(cutoffs["cut_stratum"]), "left")
    over = [F.coalesce(F.col(f"level_{rule}") >= F.col("cuts")[i], F.lit(False)) for i, rule in enumerate(RULES)]
    rejected = over[0]
    for one in over[1:]:
        rejected = rejected | one
    return judged.select(key, *COUNTS[:5], "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))
