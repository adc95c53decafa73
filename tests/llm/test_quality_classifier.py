"""The byte network: gradients by differences, whole texts by brute force, held-out rows, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import quality_classifier as qc
from loomset.llm.common import fold

from .conftest import ODD_TEXTS

TEXTS = [b"", b"x", b"plain words here " * 9, bytes(range(256)) * 3, b"AB!! " * 70]


def plain_probability(model, text):
    """One place at a time, straight from the definition."""
    halves = max(2, -(-(len(text) + qc.WIDTH - 1) // qc.HALF))
    padded = [qc.PAD] * (qc.WIDTH - 1) + [*text] + [qc.PAD] * (halves * qc.HALF - len(text))
    states = []
    for first in range(0, (halves - 1) * qc.HALF, qc.HALF):
        places = [
            sum(model.table[k, padded[i + k]].astype(float) for k in range(qc.WIDTH))
            for i in range(first, first + qc.CHUNK)
        ]
        pooled = np.max(places, axis=0)
        states.append(np.tanh(np.tanh(pooled + model.bias) @ model.mix + model.mix_bias))
    return 1 / (1 + np.exp(-(np.mean(states, axis=0) @ model.out + model.out_bias[0])))


def test_probabilities_equal_the_definition():
    model = qc.ByteNetwork.fresh(1)
    found = model.probabilities(TEXTS)
    assert found == pytest.approx([plain_probability(model, t) for t in TEXTS], abs=1e-5)
    assert found == pytest.approx([model.probabilities([t])[0] for t in TEXTS], abs=1e-6)


def test_slabs_do_not_matter(monkeypatch):
    model = qc.ByteNetwork.fresh(1)
    whole = model.probabilities(TEXTS)
    monkeypatch.setattr(qc, "SLAB", 3)
    assert model.probabilities(TEXTS) == pytest.approx(whole, abs=1e-7)


def test_gradients_equal_differences():
    model = qc.ByteNetwork(*(w.astype(np.float64) for w in qc.ByteNetwork.fresh(2).weights()))
    labels = np.array([1, 0, 1, 0, 1.0])
    _, grads = qc.gradients(model, TEXTS, labels)
    rng = np.random.default_rng(3)
    for w, g in zip(model.weights(), grads):
        flat, expected = w.reshape(-1), g.reshape(-1)
        places = np.flatnonzero(np.abs(expected) > 1e-5) if w is model.table else np.arange(len(flat))
        for i in rng.choice(places, min(6, len(places)), replace=False):
            at, step = flat[i], 1e-5
            flat[i] = at + step
            up = qc.gradients(model, TEXTS, labels)[0]
            flat[i] = at - step
            down = qc.gradients(model, TEXTS, labels)[0]
            flat[i] = at
            assert (up - down) / (2 * step) == pytest.approx(expected[i], abs=2e-4)


def test_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    model = qc.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    held = docs.where(fold(F.col("doc_id"), 5) == 0).join(labels.where("quality is not null"), "doc_id")
    rows = qc.score(held, model, ["quality"]).select("__row.quality", "__score").toPandas()
    right = (rows["__score"] >= qc.THRESHOLD) == (rows["quality"] == 1)
    assert len(rows) > 500 and right.mean() > 0.98
    assert (rows["__score"][rows["quality"] == 1] >= qc.THRESHOLD).mean() > 0.99


def test_odd_rows_and_labels(spark, documents):
    docs = documents(*((i, t) for i, t in enumerate(ODD_TEXTS)), (None, "x"), (3, "a"), (90, "good text"), (91, "bad #### ###"))
    docs = docs.withColumn("__score", F.lit("kept"))
    labels = spark.createDataFrame([(90, 1, 0), (91, 0, 1), (90, 1, 0), (5, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = qc.fit(docs.select("doc_id", "text"), known, F.lit(True))
        rows = qc.score(docs, model, docs.columns).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["__score"] <= 1 and r["__row"]["__score"] == "kept" for r in rows)
    assert model.share == 1.0 and model.network is None
    twice = qc.score(docs.where("text = 'a'"), qc.QualityModel(qc.ByteNetwork.fresh(1), 0.5), ["doc_id"]).collect()
    assert len({r["__score"] for r in twice}) == 1 and len(twice) == 3
    assert qc.score(docs.limit(0), model, ["doc_id"]).collect() == []


def test_the_sample_is_bounded_and_distinct(spark, documents):
    docs = documents(*((i, f"text {i % 30}") for i in range(90)))
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(90)], "doc_id long, quality int")
    sample = qc.labelled_texts(docs, labels, F.lit(True), "quality", 12).collect()
    assert len(sample) == 12 and len({r["text"] for r in sample}) == 12
    assert {r["label"] for r in sample} == {0}  # copies disagree: the lowest label counts
