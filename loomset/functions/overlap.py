"""Token expressions and longest-common-subsequence counts behind the ROUGE scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import pairwise
from math import isqrt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def score_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; everything else separates."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def score_text(text: Column, keep_lines: bool = False) -> Column:
    """The score tokens as one blank-separated string: the compact form to hand to Python."""
    return F.regexp_replace(F.lower(text), r"[^a-z0-9\n]+" if keep_lines else "[^a-z0-9]+", " ")


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs joined by a blank; empty below two tokens."""
    seconds = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    # zip_with pads the shorter array with null, and concat with null is null.
    joined = F.zip_with(tokens, seconds, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_compact(joined)


def common_count(predicted: Column, expected: Column) -> Column:
    """How many grams two arrays share, each as often as the side with fewer of it has it.

    Both sides go through one sorted array, where the predicted copies of a gram come before the
    expected ones; the fold keeps how many of them are still unmatched.
    """

    def tagged(side: Column, tag: int) -> Column:
        return F.transform(side, lambda gram: F.struct(gram.alias("gram"), F.lit(tag).alias("tag")))

    start = F.struct(F.lit("").alias("gram"), F.lit(0).alias("open"), F.lit(0).alias("hits"))

    def step(state: Column, item: Column) -> Column:
        left = F.when(state["gram"] == item["gram"], state["open"]).otherwise(0)
        hit = F.when(left > 0, item["tag"]).otherwise(0)
        opened = left + 1 - item["tag"] - hit
        return F.struct(item["gram"].alias("gram"), opened.alias("open"), (state["hits"] + hit).alias("hits"))

    both = F.sort_array(F.concat(tagged(predicted, 0), tagged(expected, 1)))
    return F.aggregate(both, start, step)["hits"]


def f_score(hits: Column, predicted: Column, expected: Column) -> Column:
    """Harmonic mean of precision and recall; 0 when nothing matches or a side is empty."""
    return F.when(hits > 0, 2.0 * hits / (predicted + expected)).otherwise(F.lit(0.0))


def _match_masks(tokens: Sequence[str]) -> dict[str, int]:
    masks: dict[str, int] = {}
    bit = 1
    for token in tokens:
        masks[token] = masks.get(token, 0) | bit
        bit <<= 1
    return masks


def _lcs_length(left: Sequence[str], right: Sequence[str]) -> int:
    """Bit-parallel LCS length (Hyyro 2004): one big-integer step per token of ``right``."""
    masks = _match_masks(left)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        hit = row & masks.get(token, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


def _advance(row: int, hit_mask: int, full: int) -> int:
    hit = row & hit_mask
    return ((row + hit) | (row - hit)) & full


def _lcs_positions(
    expected: Sequence[str], predicted: Sequence[str], masks: dict[str, int]
) -> list[int]:
    """Positions in ``expected`` of one LCS.

    Which one is fixed: from the end, take equal tokens; else step to the longer neighbour,
    and on a tie drop the expected token. Row i of the table is kept as a bit vector whose
    zero bits count the LCS length of each prefix of ``predicted``; ``masks`` are the latter's.
    Only every n-th row is kept, n the root of their number; those between are made again while
    walking back, one stretch at a time, so memory grows with the root only.
    """
    # An expected token that was not predicted always ties, so its row can be left out.
    places = [i for i, token in enumerate(expected) if token in masks]
    full = (1 << len(predicted)) - 1
    step = max(1, isqrt(len(places)))
    row, kept = full, [full]
    for number, place in enumerate(places, 1):
        row = _advance(row, masks[expected[place]], full)
        if number % step == 0:
            kept.append(row)

    found = []
    i, j = len(places), len(predicted)
    length = j - row.bit_count()
    start, rows = len(places), []
    while length:
        if i - 1 < start:
            start = (i - 1) // step * step
            rows = [kept[start // step]]
            for place in places[start : start + step]:
                rows.append(_advance(rows[-1], masks[expected[place]], full))
        own, above = rows[i - start], rows[i - 1 - start]
        if expected[places[i - 1]] == predicted[j - 1]:
            i, j, length = i - 1, j - 1, length - 1
            found.append(places[i])
        # A set bit: without the last predicted token the LCS is as long as with it.
        elif own >> (j - 1) & 1 and j - (above & ((1 << j) - 1)).bit_count() < length:
            j -= 1
        else:
            i -= 1
            length = j - (above & ((1 << j) - 1)).bit_count()
    return found


def _summary_hits(predicted: Sequence[Sequence[str]], expected: Sequence[Sequence[str]]) -> int:
    """Union-LCS hits over sentences; a token counts at most as often as the prediction has it.

    Only a predicted sentence that holds a token can match it, so each expected token asks the
    sentences listed for it, rarest token first, and stops as soon as it is matched; what else a
    sentence matches counts too. Equal sentences are compared once. The union is the same as over
    all pairs of sentences.
    """
    left = Counter(token for sentence in predicted for token in sentence)
    others = [(other, _match_masks(other)) for other in dict.fromkeys(map(tuple, predicted))]
    holding: dict[str, list[int]] = {}
    for number, (_, masks) in enumerate(others):
        for token in masks:
            holding.setdefault(token, []).append(number)
    hits = 0
    for sentence, times in Counter(map(tuple, expected)).items():
        matched: set[int] = set()
        asked: set[int] = set()
        places = [i for i, token in enumerate(sentence) if token in holding]
        for place in sorted(places, key=lambda i: len(holding[sentence[i]])):
            for number in holding[sentence[place]]:
                if place in matched:
                    break
                if number not in asked:
                    asked.add(number)
                    matched.update(_lcs_positions(sentence, *others[number]))
        for token, n in Counter(sentence[i] for i in matched).items():
            found = min(left[token], n * times)
            left[token] -= found
            hits += found
    return hits


def _sentences(text: str) -> list[list[str]]:
    return [line.split() for line in text.split("\n")]


def _gram_hits(predicted: Sequence, expected: Sequence) -> int:
    return (Counter(predicted) & Counter(expected)).total()


# Hits of a predicted and an expected text, by metric; lines are sentences.
_HITS = {
    "rouge1": lambda p, e: _gram_hits(p.split(), e.split()),
    "rouge2": lambda p, e: _gram_hits(list(pairwise(p.split())), list(pairwise(e.split()))),
    "rougeL": lambda p, e: _lcs_length(p.split(), e.split()),
    "rougeLsum": lambda p, e: _summary_hits(_sentences(p), _sentences(e)),
}


def all_hits(predicted: Column, expected: Column, metrics: Sequence[str]) -> Column:
    """Hits of every metric and both token counts as one struct, from one pass over a row's texts."""
    fields = [*metrics, "predicted", "expected"]

    @F.pandas_udf(StructType([StructField(name, LongType()) for name in fields]))
    def hits(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        rows = [
            (*(_HITS[metric](p, e) for metric in metrics), len(p.split()), len(e.split()))
            for p, e in zip(left, right)
        ]
        return pd.DataFrame(rows, columns=fields, dtype="int64")

    return hits(predicted, expected)


@F.pandas_udf(IntegerType())
def lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    """LCS length of two blank-separated token strings."""
    return pd.Series(
        [_lcs_length(a.split(), b.split()) for a, b in zip(left, right)], dtype="int32"
    )


@F.pandas_udf(IntegerType())
def summary_hits(predicted: pd.Series, expected: pd.Series) -> pd.Series:
    """Union-LCS hits of two texts with one sentence per line."""

    return pd.Series(
        [_summary_hits(_sentences(p), _sentences(e)) for p, e in zip(predicted, expected)],
        dtype="int32",
    )
