"""Learned operators: gradients, brute force, held-out results and odd input."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomset.llm import attention, boosting, language_id, lm_scoring, quality_rules, toxicity
from loomset.llm.common import fold

from .conftest import ODD_TEXTS, UNBROKEN_TEXTS


def plain_counts(text):
    raw = (text or "").encode()
    words = raw.split()
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


def test_counts_equal_brute_force():
    rng = random.Random(1)
    texts = [*ODD_TEXTS] + [
        "".join(rng.choice(["a ", "b ", "c\n", "ü*", "|", " "]) for _ in range(rng.randrange(200))) for _ in range(60)
    ]
    for text in texts:
        assert quality_rules.count(text)[:5] == plain_counts(text)
        ids = np.array([len(w) for w in (text or "").split()][:500])
        if len(ids) > 8:
            assert quality_rules.repeated_words(ids) == quality_rules._repeated_exactly(ids, 8)


def test_binomial_tail_is_exact():
    for errors, n, rate in ((0, 10, 0.1), (3, 50, 0.02), (7, 7, 0.5)):
        plain = sum(math.comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(errors + 1))
        assert quality_rules.tail(errors, n, rate) == pytest.approx(plain)
    assert quality_rules.tail(0, 0, 0.02) == 1.0


def test_sequences_stop_at_the_first_failure_and_share_the_error():
    assert quality_rules.holm({"a": [0.01, 0.2, 0.001], "b": []}, 0.05) == {"a": 1, "b": 0}
    # "a" passes at half the error and hands its share on to "b".
    assert quality_rules.holm({"a": [0.02], "b": [0.04]}, 0.05) == {"a": 1, "b": 1}
    assert quality_rules.holm({"a": [0.03], "b": [0.04]}, 0.05) == {"a": 0, "b": 0}


def test_false_rejection_is_limited():
    """Where junk cannot be told apart, the chance of cutoffs beyond the limit stays under alpha."""
    rng = np.random.default_rng(5)
    wrong = 0
    for _ in range(200):
        levels = rng.binomial(6, 0.05, (1500, 2)) * (rng.random((1500, 2)) < 0.3)
        bad = rng.random(1500) < 0.6
        ones = np.ones(750, int)
        steps = quality_rules.plan_steps(levels[:750], bad[:750], ones)
        good = levels[750:][~bad[750:]]
        values = quality_rules.certify(steps, good, np.ones(len(good), int), 0.02)
        held = quality_rules.holm({"s": values}, 0.05)["s"]
        if held:
            fresh = rng.binomial(6, 0.05, (200_000, 2)) * (rng.random((200_000, 2)) < 0.3)
            wrong += (fresh >= np.array(steps[held - 1])).any(1).mean() > 0.02
    assert wrong <= 20


def test_quality_rules(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    good = [" ".join(rng.choices(words, k=60)) for _ in range(1500)]
    junk = ["%% ".join(rng.choices(words, k=60)) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate(good + junk)]
    odd = [(9000 + i, t, None) for i, t in enumerate(ODD_TEXTS)]
    docs = documents(*rows, *odd, (0, good[0]))
    labels = spark.createDataFrame([(i, int(i < 1500)) for i in range(0, 2000, 2)] + [(1, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    assert len(out) == 2000 + len(odd)
    assert all(out[i].kept for i in range(1500)) and not any(out[i].kept for i in range(1500, 2000))
    for (key, text, *_) in odd:
        n, _, _, _, repeats = plain_counts(text)
        assert out[key].base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert out[key].kept == (not out[key].base_failed)
    assert quality_rules.judge(docs.where("false"), labels.where("false")).count() == 0
    assert quality_rules.judge(docs, labels.where("false")).where("kept").count() == 2001


def test_attention_gradients():
    rng = np.random.default_rng(0)
    kind = np.array([0, 1, 2, 1, 3])
    prior = np.log(rng.dirichlet(np.ones(3), 5))
    model = attention.AttentionModel.fresh(prior, kind)
    model = attention.AttentionModel(*(w.astype(float) if w.dtype == np.float32 else w for w in vars(model).values()))
    model.out[:] = rng.normal(0, 0.3, model.out.shape)
    parts = attention.blocks(rng.integers(0, 4, 90), np.array([40, 0, 50]), 4)[1:]
    seen, before, real, real_before, following = parts
    _, grads = model.gradients(seen, before, real, real_before, following)
    for weight, grad in zip(model.learned(), grads):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in weight.shape)
            old = weight[at]
            losses = []
            for step in (1e-5, -1e-5):
                weight[at] = old + step
                losses.append(model.gradients(seen, before, real, real_before, following)[0])
            weight[at] = old
            assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=2e-6)


def test_windows_score_every_position_once_and_causally():
    rng = np.random.default_rng(1)
    kind = np.array([0, 1, 1, 2])
    model = attention.AttentionModel.fresh(np.log(rng.dirichlet(np.ones(2), 4)), kind)
    model.out[:] = rng.normal(0, 1, model.out.shape)
    within = np.log(np.where(kind[None, :3] == 1, 0.5, 1.0)).repeat(4, 0)
    ids, sizes = rng.integers(0, 3, 170), np.array([100, 0, 1, 69])
    whole = attention.score(model, within, ids, sizes)
    at = 0
    for size, value in zip(sizes, whole):
        assert attention.score(model, within, ids[at : at + size], np.array([size]))[0] == pytest.approx(value, rel=1e-4)
        at += size
    # All continuations of a text have probabilities that sum to what the text has.
    head = attention.score(model, within, ids[:70], np.array([70]))[0]
    tails = [attention.score(model, within, np.append(ids[:70], i), np.array([71]))[0] for i in range(3)]
    assert np.logaddexp.reduce(tails) == pytest.approx(head, rel=1e-5)


def test_language_model(spark, documents):
    rng = random.Random(2)
    french, english = ([f"{p}{i}" for i in range(80)] for p in ("le", "the"))
    texts = [" ".join(rng.choices(rng.choice([french, english]), k=120)) for _ in range(120)]
    docs = documents(*((i, t) for i, t in enumerate(texts)), *((500 + i, t) for i, t in enumerate(ODD_TEXTS)), (0, texts[0]))
    docs = docs.withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    rows = lm_scoring.score_texts(docs, ["doc_id", "held_out"], "not held_out").collect()
    assert len(rows) == docs.count()
    pairs = docs.select("doc_id", "text").collect()
    counts = collections.Counter()
    for key, text in pairs:
        if zlib.crc32(str(key).encode()) % 7 != 2:
            counts.update([*(text or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    texts_of = dict(pairs)
    for r in rows:
        words = [*(texts_of[r.doc_id] or "").encode().lower().split(), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert math.isfinite(r.score) and r.score < 0
    nothing = lm_scoring.score_texts(docs.where("doc_id < 5"), ["doc_id"], "false").collect()
    assert {(r.n_known, r.train_tokens) for r in nothing} == {(0, 0)}
    assert lm_scoring.score_texts(docs.where("false"), ["doc_id"], "true").count() == 0


def test_learning_reads_the_ids_of_texts_that_are_encoded_once(spark, documents, monkeypatch):
    rng = random.Random(4)
    docs = documents(*((i, " ".join(rng.choices(["ab", "cd", "efg", "x-y", "Ü"], k=rng.randrange(40)))) for i in range(60)), (60, None), *((k, "ab x-y " * 40_000) for k in (61, 62)), (64, "ab"))
    seen, fit = {}, lm_scoring.fit

    def learned(encoded, *rest):
        seen["rows"], seen["rest"] = encoded.orderBy("row").toArrow(), rest
        return fit(encoded, *rest)

    monkeypatch.setattr(lm_scoring, "fit", learned)
    assert lm_scoring.score_texts(docs, ["doc_id"], "doc_id % 3 > 0").count() == 64
    rows, coder = seen["rows"], lm_scoring.encoder(lm_scoring.vocabulary_path("word_bpe_49k.json"), 1000)
    assert not {"text", "__text"} & set(rows.column_names)
    texts = dict(docs.select("doc_id", "text").collect())
    assert sorted(rows["doc_id"].to_pylist()) == [i for i in texts if i % 3]
    counts = collections.Counter()
    for key, ids in zip(rows["doc_id"].to_pylist(), rows["ids"].to_pylist()):
        ids = np.frombuffer(ids, "<u2")
        assert len(ids) == len(coder.encode(texts[key])) + 1 and ids[-1] == lm_scoring.KEPT - 2
        counts.update(ids.tolist())
    assert all(seen["rest"][0][k] == n for k, n in counts.items()) and seen["rest"][0].sum() == counts.total()


def test_training_steps_are_adams_and_scores_those_of_all_classes():
    """Weights in one array move as weights kept apart; picked classes have the log-probabilities of whole rows."""
    rng = np.random.default_rng(12)
    ids, sizes = rng.integers(0, 9, 900), np.array([1, 0, 300, 31, 32, 33, 503])
    kind = np.append(rng.integers(0, 4, 9), 4)
    fresh = attention.AttentionModel.fresh(np.log(rng.dirichlet(np.ones(4), 10)), kind)
    trained = attention.train(fresh.with_flat(fresh.flat()), ids, sizes, batch=5)
    plain = fresh.with_flat(fresh.flat())
    parts = attention.blocks(ids, sizes, 9)[1:]
    order = np.random.default_rng(1).permutation(len(parts[0]))
    first, second = ([np.zeros(w.shape) for w in plain.learned()] for _ in range(2))
    for step, at in enumerate(range(0, len(order), 5), 1):
        grads = plain.gradients(*(p[order[at : at + 5]] for p in parts))[1]
        clip = min(1.0, 1 / np.sqrt(sum((g.astype(float) ** 2).sum() for g in grads)))
        for i, (w, g) in enumerate(zip(plain.learned(), grads)):
            first[i] += 0.1 * (g * clip - first[i])
            second[i] += 0.01 * ((g * clip) ** 2 - second[i])
            w -= 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6)
    assert np.allclose(trained.flat(), plain.flat(), atol=1e-3)
    assert np.abs(trained.flat() - fresh.flat()).max() > 0.02
    seen, before, real, real_before, following = parts
    logs = trained.forward(seen, before, real, real_before, trained.tables())
    picked = trained.picked(seen, before, real, real_before, trained.tables(), following)
    assert np.array_equal(picked, np.take_along_axis(logs, kind[following][:, :, None], 2)[:, :, 0])


def plain_logs(model, seen, before, real, real_before):
    """Log-probabilities after each real position of each block, key by key in double precision."""
    found = np.zeros((*seen.shape, model.prior.shape[1]))
    own = {f: getattr(model, f).astype(float) for f in ("embed", "query", "key", "value", "distance", "mix", "out", "bias")}
    for b, i in np.argwhere(real):
        ids = [*before[b][real_before[b]], *seen[b, : i + 1]]
        x = own["embed"][ids]
        product = x @ own["key"] @ own["query"].T @ x[-1] / np.sqrt(attention.WIDTH) + own["distance"][len(ids) - 1 - np.arange(len(ids))]
        weight = np.exp(product - product.max())
        read = weight @ (x @ own["value"]) / weight.sum()
        logits = np.tanh(np.concatenate([x[-1], read]) @ own["mix"]) @ own["out"] + own["bias"] + model.prior[seen[b, i]]
        found[b, i] = logits - logits.max() - np.log(np.exp(logits - logits.max()).sum())
    return found


@pytest.mark.parametrize("large", [1, 40])
def test_scores_are_raised_without_overflow_and_weights_move_in_one_array(large):
    """Small scores are raised as they are, large ones by what they lack to the largest: either way as key by key."""
    rng = np.random.default_rng(7)
    ids, sizes = rng.integers(0, 9, 150), np.array([70, 0, 1, 79])
    kind = np.append(rng.integers(0, 4, 9), 4)
    fresh = attention.AttentionModel.fresh(np.log(rng.dirichlet(np.ones(4), 10)), kind)
    fresh.out[:] = large * rng.normal(0, 1, fresh.out.shape)
    fresh.query *= 10 * large
    seen, before, real, real_before, following = attention.blocks(ids, sizes, 9)[1:]
    tables = fresh.tables()
    logs = fresh.forward(seen, before, real, real_before, tables)
    assert np.allclose(logs[real], plain_logs(fresh, seen, before, real, real_before)[real], rtol=2e-4, atol=2e-3)
    loss, grads = fresh.gradients(seen, before, real, real_before, following)
    picked = fresh.picked(seen, before, real, real_before, tables, following)
    assert loss == pytest.approx(-picked[real].mean(), rel=1e-5) and all(np.isfinite(g).all() for g in grads)
    trained = attention.train(fresh.with_flat(fresh.flat()), ids, sizes, batch=3)
    assert all(w.base is trained.embed.base is not None for w in trained.learned())
    assert np.isfinite(trained.flat()).all()


def test_sketches_sum_the_codes_of_neighbours():
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 9, n) for n in (7, 1, 30)]
    codes = rng.normal(0, 1, (lm_scoring.KEPT, lm_scoring.SKETCH))
    batch = pa.RecordBatch.from_pydict({"ids": [t.astype("<u2").tobytes() for t in texts], "text_bytes": [2 * len(t) for t in texts]})
    (found,) = lm_scoring._sketched(iter([batch, batch]), codes)
    sums = np.zeros(lm_scoring.KEPT * 2 * lm_scoring.SKETCH)
    sums[found.column("place").to_numpy()] = found.column("weight").to_numpy()
    plain = np.zeros((lm_scoring.KEPT, 2, lm_scoring.SKETCH))
    for t in texts * 2:
        for left, right in zip(t, t[1:]):
            plain[left, 0] += codes[right]
            plain[right, 1] += codes[left]
    assert np.allclose(sums, plain.ravel())


def test_trees_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (3000, 4))
    chance = np.where((x[:, 0] > 0.3) ^ (x[:, 2] > 0), 0.9, 0.1)
    y = (rng.random(3000) < chance).astype(float)
    margin = boosting.fit_trees(x[:2000], y[:2000]).margin(x[2000:])
    assert ((margin > 0) == (chance[2000:] > 0.5)).mean() > 0.95
    xs, ys = boosting.fit_isotonic(margin, y[2000:])
    assert (np.diff(ys) >= 0).all() and 0 < ys[0] < 0.2 and 0.8 < ys[-1] < 1
    assert boosting.fit_trees(np.zeros((30, 2)), np.tile([0.0, 1.0], 15)).margin(np.ones((2, 2))) == pytest.approx([0, 0])


def test_toxicity(spark, documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]

    def text(toxic):
        own = rng.choices(words, k=40)
        for _ in range(3 * toxic):
            own.insert(rng.randrange(40), rng.choice(["you idiot", "MORON!", "1d10t", f"zorq{rng.choice(['en', 'el', 'a'])}"]))
        return " ".join(own)

    rows = [(i, text(i % 5 == 0)) for i in range(1500)]
    docs = documents(*rows, *((9000 + i, t) for i, t in enumerate(ODD_TEXTS)), (0, rows[0][1]))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1500)] + [(3, None)], "doc_id long, toxic int")
    known = toxicity.labelled_rows(docs, labels, fold(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(known)
    scored = {r["__row"].doc_id: r["__score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    held_out = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = [(scored[i] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in held_out]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= s <= 1 for s in scored.values()) and len(scored) == 1500 + len(ODD_TEXTS)
    one_kind = toxicity.fit(known.where("label = 0"))
    assert {r["__score"] for r in toxicity.score(docs, one_kind, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), toxicity.fit(known.where("false")), ["doc_id"]).count() == 0


def test_texts_go_to_the_scoring_tasks_once(documents):
    docs = documents(*((i, t) for i, t in enumerate(ODD_TEXTS)))
    model = toxicity.ToxicityModel({b"word": 2.0}, boosting.fit_trees(np.arange(2250.0).reshape(150, 15), np.arange(150) % 2), (np.array([-1.0, 1.0]), np.array([0.0, 1.0])), 0.5)
    whole, narrow = toxicity.score(docs, model, docs.columns), toxicity.score(docs, model, ["doc_id"])
    sent = whole._jdf.queryExecution().analyzed().children().head().output()
    assert sent.size() == 1  # the row with its text, without a second copy
    assert [tuple(r["__row"]) for r in whole.collect()] == [tuple(r) for r in docs.collect()]
    assert [(r["__row"].doc_id, r["__score"]) for r in whole.collect()] == [(r["__row"].doc_id, r["__score"]) for r in narrow.collect()]


@pytest.mark.parametrize("text, hits", [(b"You IDIOT!", 1), (b"i d i o t", 1), (b"id!ot and 1d10t", 2), (b"perfectly fine", 0)])
def test_toxic_features(text, hits):
    found = dict(zip(toxicity.FEATURES, toxicity.features(text, {})))
    assert round(math.expm1(found["lexicon_hits"]) + math.expm1(found["odd_hits"])) == hits


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    layer = language_id.Direction(*(rng.normal(0, 0.5, s) for s in ((257, 24), (8, 16), (8, 8))))
    codes = rng.integers(0, 5, (7, 3))
    weigh = rng.normal(0, 1, (7, 3, 8))

    def states():
        made = [np.zeros((3, 8))]
        h = 8
        for t in range(7):
            x, old = layer.table[codes[t]], made[-1]
            both = 1 / (1 + np.exp(-(x[:, : 2 * h] + old @ layer.gates)))
            n = np.tanh(x[:, 2 * h :] + both[:, h:] * (old @ layer.candidate))
            made.append(n + both[:, :h] * (old - n))
        return np.stack(made)

    assert np.allclose(states(), layer.run(codes), atol=1e-5)
    made, saved = layer.run(codes, True)
    grads = layer.back(codes, made.astype(float), saved, weigh)
    for weight, grad in zip((layer.table, layer.gates, layer.candidate), grads):
        for _ in range(4):
            at = tuple(rng.integers(0, min(5, s)) for s in weight.shape)
            old, losses = weight[at], []
            for step in (1e-5, -1e-5):
                weight[at] = old + step
                losses.append((states()[1:] * weigh).sum())
            weight[at] = old
            assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-3)


def test_language_id(spark, documents):
    rng = random.Random(6)
    sounds = {"aa": ["ka", "ki", "ko"], "bb": ["schu", "ße", "ü"], None: ["x"]}
    rows = []
    for i in range(400):
        lang = rng.choice(list(sounds))
        rows.append((i, "".join(rng.choices([*sounds[lang], " "], k=rng.choice([30, 400]))), lang))
    docs = documents(*rows, *((900 + i, t, None) for i, t in enumerate([*ODD_TEXTS, "123 !!", "½ ²"])), (0, rows[0][1], rows[0][2]))
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    out = {r.doc_id: r for r in language_id.predict(docs, model, ["doc_id"]).collect()}
    tried = [i for i, _, lang in rows if lang and zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(out[i].lang_pred == rows[i][2] for i in tried) > 0.97 * len(tried)
    assert all(out[900 + i].lang_pred == "und" for i in (0, 1, 2, len(ODD_TEXTS), len(ODD_TEXTS) + 1))
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == docs.count() - 1
    assert language_id.fit(docs.where("lang is null")) is None
    assert {r.lang_pred for r in language_id.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(docs.where("false"), model, ["doc_id"]).count() == 0


def test_every_position_is_labelled_whatever_the_cut():
    rng = np.random.default_rng(3)
    directions = [language_id.Direction(*(rng.normal(0, 0.5, s).astype(np.float32) for s in ((257, 24), (8, 16), (8, 8)))) for _ in range(2)]
    for d in directions:
        d.table[language_id.PAD] = [-30.0] * 16 + [0.0] * 8
    model = language_id.LanguageModel(["a", "b"], *directions, rng.normal(0, 1, (16, 2)).astype(np.float32), np.zeros(2, np.float32))
    texts = [bytes(rng.integers(1, 255, n).tolist()) for n in (1, 5, 111, 112)] + [b""]
    for text, row in zip(texts, model.pooled(texts)):
        if text:
            alone = model.probabilities(np.frombuffer(text, np.uint8).astype(np.int64)[:, None])[:, 0].mean(0)
            assert row == pytest.approx(alone, rel=1e-4) and row.sum() == pytest.approx(1, rel=1e-5)


def test_odd_words_are_those_of_the_plain_pattern():
    plain = re.compile(rb"[a-z]+(?:[0-9@$!|+*._-]+[a-z]+)+|[0-9@$!|+]+[a-z]+[0-9@$!|+a-z]*")
    rng = random.Random(12)
    for _ in range(3000):
        text = bytes(rng.choice(b"ab1@-. *") for _ in range(rng.randrange(40)))
        assert toxicity._ODD_WORD.findall(text) == plain.findall(text)


def test_features_of_unbroken_texts_take_linear_time():
    for text in UNBROKEN_TEXTS:
        start = time.perf_counter()
        toxicity.features(text.encode(), {b"aaaa": 3.0})
        assert time.perf_counter() - start < 8


def test_more_labels_than_a_network_is_wide(spark):
    """Every label can be predicted, however many there are and however rare one is."""
    rows = [(chr(0x4E00 + k) * 30 + str(i), f"l{k:03d}") for k in range(70) for i in range(3)]
    labelled = spark.createDataFrame([*rows, ("rare \u1234 text", "once")], "text string, lang string")
    model = language_id.fit(labelled)
    assert model.languages == sorted({lang for _, lang in rows} | {"once"})
    few = language_id.fit(labelled, total=71)
    assert few.languages == model.languages


def test_copies_count_once_and_never_lie_in_both_halves(spark, documents, monkeypatch):
    texts = [f"word{i} " * 3 + " ".join(f"t{i}x{j}" for j in range(30)) for i in range(12)]
    docs = documents(*((100 * c + i, t) for i, t in enumerate(texts) for c in range(5)))
    labels = spark.createDataFrame([(100 * c + i, int(i < 6 or c > 0)) for i in range(12) for c in range(5)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_rules, "choose_cutoffs", lambda labelled, *_: seen.extend(labelled.collect()) or [])
    quality_rules.judge(docs, labels)
    assert len(seen) == len({r["text_hash"] for r in seen}) == 12
    assert sum(r["good"] for r in seen) == 6  # one bad copy makes the text bad
