"""Quality by a convolutional network over bytes, trained and run in numpy.

Learned filters read ``WIDTH`` neighbouring bytes each; since a byte is one of 256, a filter is a table
of weights per place and byte, and a position's response the sum of ``WIDTH`` looked-up rows. Chunks
of ``CHUNK`` bytes that overlap by half cover the whole document, its ends padded. Each filter is
max-pooled within a chunk, a hidden layer reads the pooled responses, and the mean of the hidden states
over all chunks gives one probability per document.

Texts are read whole for scoring. Training uses at most ``FIT_ROWS`` distinct labelled texts, drawn by
hash from all that may be learned from, and of each at most ``FIT_BYTES`` in a row, from a place that
the hash chooses anywhere in the text.

Defined results: a null text is empty; an empty text is one chunk of padding and scored like any other;
repeated rows score alike; of several labels for one text the lowest counts; without labels of both
kinds every score is the share of label 1 among those there are (1 if there are none, so that nothing
is rejected); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import labelled_texts

#: Labelled texts that the network is trained on at most, and bytes of each at most.
FIT_ROWS = 4_000
FIT_BYTES = 1_024
#: A score from here on predicts label 1.
THRESHOLD = 0.3
WIDTH = 5
FILTERS = 16
HIDDEN = 12
#: Bytes of half a chunk: chunks begin at its multiples and are twice as long.
HALF = 64
CHUNK = 2 * HALF
#: Stands for places outside the text.
PAD = 256
#: Half chunks that are run at once.
SLAB = 2_048


@dataclass
class ByteNetwork:
    """Filter tables, hidden layer and output."""

    table: np.ndarray  # (width, 257, filters)
    bias: np.ndarray  # (filters,)
    mix: np.ndarray  # (filters, hidden)
    mix_bias: np.ndarray
    out: np.ndarray  # (hidden,)
    out_bias: np.ndarray  # (1,)

    @classmethod
    def fresh(cls, seed: int) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.4, (WIDTH, PAD + 1, FILTERS))
        table[:, PAD] = 0
        parts = (table, np.zeros(FILTERS), rng.normal(0, 0.3, (FILTERS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1))
        return cls(*(part.astype(np.float32) for part in parts))

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.mix, self.mix_bias, self.out, self.out_bias]

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Filter responses at all places of ``codes`` but the last ``WIDTH - 1``."""
        n = len(codes) - WIDTH + 1
        total = np.take(self.table[0], codes[:n], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.table[k], codes[k : k + n], axis=0)
        return total

    def half_maxima(self, codes: np.ndarray) -> np.ndarray:
        """(halves, filters): each filter's maximum per half chunk; codes: halves * HALF + WIDTH - 1."""
        halves = (len(codes) - WIDTH + 1) // HALF
        out = np.empty((halves, FILTERS), np.float32)
        for at in range(0, halves, SLAB):
            end = min(halves, at + SLAB)
            places = self.responses(codes[at * HALF : end * HALF + WIDTH - 1])
            out[at:end] = places.reshape(end - at, HALF, FILTERS).max(1)
        return out

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each whole text."""
        codes, halves = coded(texts)
        maxima = self.half_maxima(codes)
        first, owner = chunk_places(halves)
        pooled = np.maximum(maxima[first], maxima[first + 1])
        hidden = np.tanh(np.tanh(pooled + self.bias) @ self.mix + self.mix_bias)
        chunks = halves - 1
        mean = np.stack([np.bincount(owner, column, len(texts)) for column in hidden.T], 1) / chunks[:, None]
        return 1 / (1 + np.exp(-(mean @ self.out.astype(float) + float(self.out_bias[0]))))


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts one after the other, each padded to whole half chunks, and their number.

    A text has at least two halves and begins with ``WIDTH - 1`` places of padding, so that a filter
    that starts in the text before sees nothing of it.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    halves = np.maximum(2, -(-(sizes + WIDTH - 1) // HALF))
    codes = np.full(int(halves.sum()) * HALF + WIDTH - 1, PAD, np.int64)
    begins = (np.cumsum(halves) - halves) * HALF + WIDTH - 1
    flat = np.frombuffer(b"".join(texts), np.uint8)
    codes[np.arange(len(flat)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)] = flat
    return codes, halves


def chunk_places(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first half of every chunk, and the text that the chunk is of."""
    owner = np.repeat(np.arange(len(halves)), halves - 1)
    return np.arange(len(owner)) + owner, owner


def gradients(model: ByteNetwork, texts: list[bytes], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean logistic loss and its gradients, back through the pooling to the bytes that won it."""
    codes, halves = coded(texts)
    places = model.responses(codes).reshape(-1, HALF, FILTERS)
    winner = places.argmax(1)
    maxima = np.take_along_axis(places, winner[:, None], 1)[:, 0]
    first, owner = chunk_places(halves)
    later = maxima[first + 1] > maxima[first]
    pooled = np.where(later, maxima[first + 1], maxima[first])
    active = np.tanh(pooled + model.bias)
    hidden = np.tanh(active @ model.mix + model.mix_bias)
    chunks = (halves - 1).astype(np.float32)
    mean = np.add.reduceat(hidden, np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])) / chunks[:, None]
    logit = mean @ model.out + model.out_bias[0]
    p = 1 / (1 + np.exp(-logit))
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    d = ((p - labels) / len(texts)).astype(np.float32)
    g_out, g_out_bias = mean.T @ d, np.array([d.sum()], np.float32)
    d_hidden = (d / chunks)[owner, None] * model.out * (1 - hidden * hidden)
    g_mix, g_mix_bias = active.T @ d_hidden, d_hidden.sum(0)
    d_pooled = (d_hidden @ model.mix.T) * (1 - active * active)
    won = first[:, None] + later
    at = won * HALF + np.take_along_axis(winner, won, 0)
    g_table = np.zeros(WIDTH * (PAD + 1) * FILTERS, np.float32)
    filters, size = np.arange(FILTERS), (PAD + 1) * FILTERS
    for k in range(WIDTH):
        cells = k * size + codes[at + k] * FILTERS + filters
        g_table += np.bincount(cells.ravel(), d_pooled.ravel(), len(g_table)).astype(np.float32)
    g_table = g_table.reshape(model.table.shape)
    g_table[:, PAD] = 0
    return loss, [g_table, d_pooled.sum(0), g_mix, g_mix_bias, g_out, g_out_bias]


def train(texts: list[bytes], labels: np.ndarray, steps: int = 1_200, batch: int = 64, rate: float = 0.01, seed: int = 5) -> ByteNetwork:
    """Adam over random batches, the rate falling to a tenth."""
    rng = np.random.default_rng(seed)
    model = ByteNetwork.fresh(seed)
    share = min(max(float(labels.mean()), 0.01), 0.99)
    model.out_bias[0] = np.log(share / (1 - share))
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(texts))])
        rows, order = order[:batch], order[batch:]
        _, grads = gradients(model, [texts[i] for i in rows], labels[rows])
        now = rate * (1 - 0.9 * step / steps)
        for w, g, m, v in zip(model.weights(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return model


@dataclass
class QualityModel:
    network: ByteNetwork | None
    share: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), self.share)
        return self.network.probabilities(texts)


def _excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most ``FIT_BYTES`` of each text, from a place chosen by the text's hash."""
    for batch in batches:
        cut = []
        for text, draw in zip(batch.column("text"), batch.column("draw").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            start = (draw & 0x7FFFFFFF) % max(1, len(raw) - FIT_BYTES + 1)
            cut.append(raw[start : start + FIT_BYTES])
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("draw"), pa.array(cut, pa.binary())], names=["label", "draw", "text"]
        )


def fit(docs: DataFrame, labels: DataFrame, where: Column, key: str = "doc_id", rows: int = FIT_ROWS) -> QualityModel:
    """Train on at most ``rows`` texts of ``docs`` (key, text) with a label in ``labels.quality``.

    ``where`` says which rows may be learned from. The driver gets ``rows`` excerpts at most.
    """
    sample = labelled_texts(docs, labels, where, "quality", rows, key)
    found = sample.mapInArrow(_excerpts, "label int, draw long, text binary").orderBy("draw").toPandas()
    y = found["label"].to_numpy(np.float32)
    if not len(y) or y.min() == y.max():
        return QualityModel(None, float(y.mean()) if len(y) else 1.0)
    return QualityModel(train([bytes(t) for t in found["text"]], y), float(y.mean()))


def _score_rows(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores, part, held = [], [], 0
        for text in batch.column("__text"):
            part.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
            held += len(part[-1])
            if held > 1 << 20:
                scores.append(model.score(part))
                part, held = [], 0
        scores.append(model.score(part))
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), pa.array(np.concatenate(scores), pa.float64())], names=["__row", "__score"]
        )


def score(docs: DataFrame, model: QualityModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row as struct ``__row``, and the ``__score`` of its whole text."""
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in columns)).alias("__row"), F.col(text).cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("__score", "double")
    return rows.mapInArrow(lambda batches: _score_rows(batches, model), schema)
