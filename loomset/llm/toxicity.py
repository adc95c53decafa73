"""Toxicity: gradient-boosted trees over dense features of whole texts, calibrated isotonically.

Features: densities of a general lexicon and of a lexicon of stems learned from labelled rows, how
many hits stand near second-person words, capitals, punctuation, and how many words are obfuscated
(digits or signs inside, letters spaced out). The model is fitted on a bounded sample of labelled
rows, drawn by hash from all of them; every document is scored over its whole text.

Defined results: a null text is empty and scored like any other; repeated rows score alike; without
labels of both kinds every score is the share of label 1 among those there are (0 for none); an
empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.boosting import Trees, fit_isotonic, fit_trees
from loomset.llm.common import stored

#: Labelled rows that the model is fitted on at most, and stems of the learned lexicon at most.
FIT_ROWS = 16_000
STEMS = 3_000
#: A stem must occur in so many texts of label 1, and be this much likelier (log) there.
STEM_TEXTS = 4
STEM_ODDS = 2.3
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
NEAR = 6

# Common insults in four languages.
LEXICON = frozenset(
    """asshole bastard bitch clown coward creep cretin crap damn dimwit disgusting dumb dumbass fool
    fuck fucking garbage hate idiot idiotic imbecile jerk kill liar loser lunatic moron moronic
    pathetic pervert pig piss psycho racist retard scum shit shut stupid sucks trash ugly vermin
    vile whore worthless
    abschaum arschloch blödmann depp dreck dummkopf ekelhaft erbärmlich hurensohn idioten
    scheiße scheisse schwein trottel verdammt versager wertlos widerlich
    abruti bâtard connard connasse crétin débile dégoûtant imbécile merde minable ordure pathétique
    pourriture putain salaud salope
    asqueroso basura bastardo cabrón estúpido gilipollas idiota imbécil inútil mierda patético
    payaso perdedor puta""".encode().split()
)
# Second-person words in four languages.
SECOND = frozenset(
    """you your yours yourself ya u ur youre du dich dir dein deine deinen deiner ihr euch euer tu toi
    te ton ta tes vous votre vos tú ti usted ustedes vosotros contigo""".encode().split()
)
# Signs that stand for letters.
LEET = bytes.maketrans(b"013457@$!|+", b"oieastasiit")

_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_CLEAN = bytes.maketrans(bytes(range(65, 91)) + _SIGNS, bytes(range(97, 123)) + b" " * len(_SIGNS))
# A run of letters, digits or signs is tried from its start only and never given back in part, so
# texts without a break take linear time; runs tried from within would not match either.
_ODD_WORD = re.compile(
    rb"(?<![a-z])[a-z]++(?:[0-9@$!|+*._-]++[a-z]++)++"
    rb"|(?<![0-9@$!|+])[0-9@$!|+]++[a-z]++[0-9@$!|+a-z]*+"
)
_SPACED = re.compile(rb"(?<![^\s.,;:*_-])(?:[a-z][\s.*_-]){3,}[a-z](?![^\s.,;:*_-])")
_DROP = b"*._- \t\n\r\x0b\x0c"
#: Kinds of bytes: other, capital, small letter, digit, exclamation or question mark, other sign.
_KINDS = np.zeros(256, np.uint8)
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 1, 2, 3
_KINDS[list(_SIGNS)] = 5
_KINDS[list(b"!?")] = 4

FEATURES = (
    "words", "lexicon", "lexicon_hits", "learned", "learned_hits", "learned_best", "near_second",
    "second", "capitals", "marks", "signs", "digits", "odd_words", "odd_hits", "shouted",
)


def features(text: bytes, stems: dict[bytes, float]) -> list[float]:
    """Dense features of one whole text in UTF-8."""
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=6) if text else np.zeros(6)
    low = text.lower()
    words = low.translate(_CLEAN).split()
    n = max(1, len(words))
    seeds = [i for i, w in enumerate(words) if w in LEXICON]
    learned, best = [], 0.0
    if stems:
        get = stems.get
        for i, w in enumerate(words):
            weight = get(w) or get(w[:6]) or get(w[:5]) or get(w[:4])
            if weight:
                learned.append(i)
                best = max(best, weight)
    odd = _ODD_WORD.findall(low) + _SPACED.findall(low)
    plain = [w.translate(LEET).translate(None, _DROP) for w in odd]
    odd_hits = sum(p in LEXICON or p in stems for p in plain)
    hits = sorted({*seeds, *learned})
    near = sum(any(w in SECOND for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    letters = max(1, kinds[1] + kinds[2])
    size = max(1, len(text))
    shouted = sum(len(w) > 2 and w.isupper() for w in text.split()) / n if kinds[1] > 2 else 0.0
    return [
        np.log1p(len(words)), len(seeds) / n, np.log1p(len(seeds)), len(learned) / n, np.log1p(len(learned)), best,
        near / n, sum(map(SECOND.__contains__, words)) / n, kinds[1] / letters, kinds[4] / size, kinds[5] / size,
        kinds[3] / size, len(odd) / n, np.log1p(odd_hits), shouted,
    ]


def text_stems(text: bytes) -> set[bytes]:
    """Words of a text and their prefixes that can carry a learned weight."""
    words = {w for w in text.lower().translate(_CLEAN).split() if len(w) > 2}
    return words.union(*({w[:n] for w in words if len(w) > n} for n in PREFIXES))


def _stem_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            toxic, clean = {}, {}
            for label, text in zip(part.column("label").to_pylist(), part.column("text")):
                counts = toxic if label else clean
                for stem in text_stems(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    counts[stem] = counts.get(stem, 0) + 1
            stems = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(stems, pa.binary()),
                    pa.array([toxic.get(s, 0) for s in stems], pa.int64()),
                    pa.array([clean.get(s, 0) for s in stems], pa.int64()),
                ],
                names=["stem", "toxic", "clean"],
            )


def learn_stems(labelled: DataFrame, limit: int = STEMS) -> dict[bytes, float]:
    """Stems that mark label 1: at most ``limit``, each with its log odds. Rows: label, text."""
    totals = labelled.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic_n, clean_n = totals["toxic"] or 0, (totals["n"] or 0) - (totals["toxic"] or 0)
    counts = labelled.mapInArrow(_stem_rows, "stem binary, toxic long, clean long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic_n + 1)) - F.log((F.col("clean") + 0.5) / (clean_n + 1))
    found = (
        counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= STEM_TEXTS)
        .withColumn("odds", odds)
        .where(F.col("odds") > STEM_ODDS)
        .orderBy(F.col("odds").desc(), "stem")
        .limit(limit)
    )
    return {bytes(row["stem"]): row["odds"] for row in found.collect()}


@dataclass
class ToxicityModel:
    stems: dict[bytes, float]
    trees: Trees | None
    curve: tuple[np.ndarray, np.ndarray] | None
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.base)
        return np.clip(np.interp(self.trees.margin(x), *self.curve), 0, 1)


def _feature_rows(batches: Iterator[pa.RecordBatch], stems: dict[bytes, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text"))
        rows = [features(t, stems) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"]
        )


def fit(labelled: DataFrame, seed: int = 7) -> ToxicityModel:
    """Fit on a bounded sample (label 0 or 1, text), as :func:`labelled_rows` draws it.

    For the trees, each half of the sample is described by the stems of the other half, so that the
    trees see how far stems carry beyond the texts they come from; documents are then scored with
    the stems of both. Calibration uses out-of-fold margins.
    """
    sample = stored(labelled.repartition(24, "text"), "toxicity-sample")
    half = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(2))
    tables = []
    for k in (0, 1):
        other = learn_stems(sample.where(half != k))
        described = sample.where(half == k).select("label", "text").mapInArrow(
            lambda batches, stems=other: _feature_rows(batches, stems), "label int, x array<double>"
        )
        tables.append(described.toPandas())
    table = pd.concat(tables)
    stems = learn_stems(sample)
    y = table["label"].to_numpy(float) if len(table) else np.zeros(0)
    if len(y) < 20 or y.min() == y.max():
        return ToxicityModel(stems, None, None, float(y.mean()) if len(y) else 0.0)
    x = np.stack(table["x"].to_numpy())
    order = np.lexsort((*x.T, y))  # the same order, however the rows came in
    order = np.random.default_rng(seed).permutation(order)
    x, y = x[order], y[order]
    folds = np.arange(len(y)) % 3
    margin = np.zeros(len(y))
    for k in range(3):
        margin[folds == k] = fit_trees(x[folds != k], y[folds != k]).margin(x[folds == k])
    return ToxicityModel(stems, fit_trees(x, y), fit_isotonic(margin, y), float(y.mean()))


def _score_rows(batches: Iterator[pa.RecordBatch], model: ToxicityModel, place: int | None) -> Iterator[pa.RecordBatch]:
    """``place``: where the text lies in ``__row``, if it is not a column of its own."""
    for batch in batches:
        rows = batch.column("__row")
        texts = batch.column("__text") if place is None else rows.field(place)
        x = np.zeros((batch.num_rows, len(FEATURES)))
        for i, text in enumerate(texts):
            x[i] = features(text.as_buffer().to_pybytes() if text.is_valid else b"", model.stems)
        yield pa.RecordBatch.from_arrays([rows, pa.array(model.score(x), pa.float64())], names=["__row", "__score"])


def score(docs: DataFrame, model: ToxicityModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every document as struct ``__row``, and the ``__score`` of its whole text."""
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in columns)).alias("__row"), F.col(text).alias("__text"))
    schema = rows.select("__row").schema.add("__score", "double")
    place = None
    if text in columns:  # goes to the workers once
        place, rows = columns.index(text), rows.select("__row")
    return rows.mapInArrow(lambda batches: _score_rows(batches, model, place), schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, where: Column, rows: int = FIT_ROWS, key: str = "doc_id") -> DataFrame:
    """``(label, text)`` of at most ``rows`` distinct texts that may be learned from, drawn by hash.

    Labels meet keys and text hashes only; the texts of the draw, whose size is bounded, are then
    picked out by a broadcast.
    """
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.max("toxic").cast("int").alias("label")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    wanted = docs.where(where).select(F.col(key).alias("__key"), F.xxhash64(text).alias("__draw"), text.alias("text"))
    drawn = (
        wanted.select("__key", "__draw").join(known, "__key")
        .groupBy("__draw").agg(F.max("label").alias("label"), F.min("__key").alias("__key"))
        .orderBy("__draw").limit(rows)
    )
    found = wanted.join(F.broadcast(drawn), ["__key", "__draw"])
    return found.groupBy("__draw").agg(F.first("label").alias("label"), F.first("text").alias("text")).drop("__draw")
