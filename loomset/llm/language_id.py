"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every position of a text and the document's probabilities are pooled from all of
them. Texts are read whole: cut into windows with a margin on both sides that warms the states up,
whose labels are not counted. Training runs through time in numpy, on a bounded sample of labelled
windows drawn by hash from all labelled documents; windows are drawn from anywhere in a text.

Defined results: a null text or one without a letter is ``und`` with score 0; without any labelled
text everything is ``und``; repeated rows get the same result; ties go to the first language in
code-point order; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import stored

#: Windows that training uses per language at most, and of all languages together; their bytes. A
#: labelled text gives one window.
FIT_WINDOWS = 2_000
ALL_WINDOWS = 128_000
WINDOW = 64
#: States per direction.
STATES = 8
#: Bytes that are labelled per window when scoring, and the margin on each side.
CORE, MARGIN = 112, 8
#: Windows that are run at once.
SLAB = 2048
PAD = 256

_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Direction:
    """One gated recurrent layer: input table (byte to gates), recurrent weights and bias."""

    table: np.ndarray  # (257, 3h): update, reset, candidate
    gates: np.ndarray  # (h, 2h)
    candidate: np.ndarray  # (h, h)

    def run(self, codes: np.ndarray, keep: bool = False):
        """States after each step of ``codes`` (time, batch); with ``keep`` also what training needs."""
        steps, batch = codes.shape
        h = self.candidate.shape[0]
        states = np.zeros((steps + 1, batch, h), np.float32)
        saved = []
        for t in range(steps):
            old = states[t]
            x = np.take(self.table, codes[t], axis=0)
            both = _sigmoid(x[:, : 2 * h] + old @ self.gates)
            z, r = both[:, :h], both[:, h:]
            inner = old @ self.candidate
            n = np.tanh(x[:, 2 * h :] + r * inner)
            np.add(n, z * (old - n), out=states[t + 1])
            if keep:
                saved.append((z, r, n, inner))
        return (states, saved) if keep else states

    def back(self, codes: np.ndarray, states: np.ndarray, saved: list, upper: np.ndarray) -> list[np.ndarray]:
        """Gradients through time; ``upper`` is the loss's gradient for each state."""
        h = self.candidate.shape[0]
        table, gates, candidate = (np.zeros_like(w) for w in (self.table, self.gates, self.candidate))
        carry = np.zeros_like(states[0])
        for t in range(len(codes) - 1, -1, -1):
            z, r, n, inner = saved[t]
            old = states[t]
            grad = upper[t] + carry
            dn = grad * (1 - z) * (1 - n * n)
            dz = grad * (old - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            dinner = dn * r
            both = np.concatenate([dz, dr], 1)
            np.add.at(table, codes[t], np.concatenate([both, dn], 1))
            gates += old.T @ both
            candidate += old.T @ dinner
            carry = grad * z + both @ self.gates.T + dinner @ self.candidate.T
        table[PAD] = 0
        return [table, gates, candidate]


@dataclass
class LanguageModel:
    languages: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray  # (2h, languages)
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        own = [w for d in (self.ahead, self.behind) for w in (d.table, d.gates, d.candidate)]
        return [*own, self.out, self.bias]

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(time, batch, languages) for codes (time, batch)."""
        both = np.concatenate([self.ahead.run(codes)[1:], self.behind.run(codes[::-1])[:0:-1]], 2)
        logits = both @ self.out + self.bias
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        return p

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): mean probabilities over all positions of each text."""
        total = np.zeros((len(texts), len(self.languages)))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16)
        begins = np.cumsum(sizes) - sizes
        parts = -(-sizes // CORE)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        reach = np.arange(-MARGIN, CORE + MARGIN)
        for at in range(0, len(owner), SLAB):
            who = owner[at : at + SLAB]
            place = nth[at : at + SLAB, None] * CORE + reach  # within the text
            inside = (place >= 0) & (place < sizes[who, None])
            codes = np.where(inside, flat[np.where(inside, begins[who, None] + place, 0)], np.int16(PAD)).T
            scores = self.probabilities(np.ascontiguousarray(codes, np.int64))[MARGIN : MARGIN + CORE]
            counted = inside.T[MARGIN : MARGIN + CORE]
            sums = np.einsum("tbl,tb->bl", scores, counted.astype(np.float32))
            for k in range(total.shape[1]):
                total[:, k] += np.bincount(who, sums[:, k], len(texts))
        return total / np.maximum(1, sizes)[:, None]


def train(windows: list[bytes], labels: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 3) -> LanguageModel:
    """Back-propagation through time with Adam; every position of a window bears its label."""
    rng = np.random.default_rng(seed)
    h = STATES

    def direction() -> Direction:
        table = rng.normal(0, 0.3, (257, 3 * h))
        table[PAD] = [-30.0] * (2 * h) + [0.0] * h  # closed gates: outside the text the state is zero
        return Direction(*(w.astype(np.float32) for w in (table, rng.normal(0, 0.3, (h, 2 * h)), rng.normal(0, 0.3, (h, h)))))

    out = rng.normal(0, 0.3, (2 * h, len(languages))).astype(np.float32)
    model = LanguageModel(languages, direction(), direction(), out, np.zeros(len(languages), np.float32))
    codes = np.full((len(windows), WINDOW), PAD, np.int64)
    for row, text in zip(codes, windows):
        row[: len(text)] = np.frombuffer(text, np.uint8)
    # Classes weigh alike, however often they occur.
    share = np.bincount(labels, minlength=len(languages))
    weigh = (len(labels) / np.maximum(1, share) / len(languages)).astype(np.float32)
    first, second = [np.zeros_like(w) for w in model.weights()], [np.zeros_like(w) for w in model.weights()]
    step = 0
    steps = epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, y = np.ascontiguousarray(codes[rows].T), labels[rows]
            ahead, ahead_saved = model.ahead.run(x, True)
            turned = np.ascontiguousarray(x[::-1])
            behind, behind_saved = model.behind.run(turned, True)
            both = np.concatenate([ahead[1:], behind[:0:-1]], 2)
            logits = both @ model.out + model.bias
            p = np.exp(logits - logits.max(2, keepdims=True))
            p /= p.sum(2, keepdims=True)
            real = (x != PAD).astype(np.float32) * weigh[y]
            p[:, np.arange(len(rows)), y] -= 1
            p *= (real / max(1.0, real.sum()))[:, :, None]
            upper = p @ model.out.T
            grads = [
                *model.ahead.back(x, ahead, ahead_saved, upper[:, :, :h]),
                *model.behind.back(turned, behind, behind_saved, upper[::-1, :, h:]),
                np.tensordot(both, p, ((0, 1), (0, 1))),
                p.sum((0, 1)),
            ]
            size = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            now = rate * (1 - 0.9 * step / steps) * min(1.0, 1.0 / max(size, 1e-8))
            for w, g, m, v in zip(model.weights(), grads, first, second):
                g = g * min(1.0, 1.0 / max(size, 1e-8))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window from a hash-chosen place of each text."""
    for batch in batches:
        out = []
        for text, draw in zip(batch.column("text"), batch.column("draw").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            start = (draw & 0x7FFFFFFF) % max(1, len(raw) - WINDOW + 1)
            out.append(raw[start : start + WINDOW])
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.binary())], names=["lang", "window"])


def fit(labelled: DataFrame, most: int = FIT_WINDOWS, total: int = ALL_WINDOWS) -> LanguageModel | None:
    """Train on at most ``most`` texts of every label there is, ``total`` of all of them.

    ``labelled`` has ``lang`` and ``text``. None if there is nothing to learn from. The draw is a
    threshold on a hash per label, so no label's rows meet in one task. Every label keeps at least one
    window.
    """
    usable = labelled.where("lang is not null and text rlike '\\\\p{L}'").select(
        "lang", "text", F.xxhash64("text", F.lit("window")).alias("draw")
    )
    counts = stored(usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")), "languages")
    names = sorted(row["lang"] for row in counts.select("lang").collect())
    if not names:
        return None
    most = max(1, min(most, total // len(names)))
    # Half as many again as wanted; the rest is cut after the draw.
    chosen = (F.pmod("draw", F.lit(1_000_003)) < F.least(F.lit(1.0), 1.5 * most / F.col("n")) * 1_000_003) | (F.col("draw") == F.col("least"))
    drawn = usable.join(counts, "lang").where(chosen).select("lang", "text", "draw")
    found = drawn.mapInArrow(_windows, "lang string, window binary").distinct().toPandas()
    found = found.sort_values(["lang", "window"]).reset_index(drop=True)
    found = found.sample(frac=1, random_state=5).groupby("lang").head(most)
    labels = found["lang"].map({name: k for k, name in enumerate(names)}).to_numpy()
    return train([bytes(w) for w in found["window"]], labels, names)


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        found, scores = ["und"] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if model and t is not None and _LETTER.search(t)]
        if rows:
            raw = [texts[i].encode("utf-8", "replace") for i in rows]
            p = np.clip(model.pooled(raw), 0, 1)
            for i, best, row in zip(rows, p.argmax(1), p):
                found[i], scores[i] = model.languages[best], float(row[best])
        names = [n for n in batch.schema.names if n != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(found), pa.array(scores)], names=[*names, "lang_pred", "score"]
        )


def predict(docs: DataFrame, model: LanguageModel | None, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every document, ``lang_pred`` and ``score`` of its whole text."""
    rows = docs.select(*columns, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(lambda batches: _predict(batches, model), schema)
