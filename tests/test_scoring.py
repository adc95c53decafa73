import random
import re
import time
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loomset.errors import AlignmentError
from loomset.functions import overlap
from loomset.operators import comparing, profiling, rouge
from loomset.operators.predicting import batch_predict, clean_prediction

SCHEMA = "example_id long, model string, prediction string, target string"


def pairs_of(spark, *texts):
    return spark.createDataFrame([(i, "m", p, t) for i, (p, t) in enumerate(texts)], SCHEMA)


def by_metric(scores):
    return {(r.example_id, r.metric): r for r in scores.collect()}


CASES = [
    ("the cat sat", "the cat sat", 1, 1, 1),
    ("The CAT, sat!", "the cat sat", 1, 1, 1),
    ("", "the cat", 0, 0, 0),
    ("the cat", "", 0, 0, 0),
    ("", "", 0, 0, 0),
    (None, "x", 0, 0, 0),
    ("cat", "cat", 1, 0, 1),
    ("a b c d", "d c b a", 1, 0, 0.25),
    ("a a a b", "a b b b", 0.5, 1 / 3, 0.5),
    ("été 漢字", "t", 2 / 2, 0, 1),
    ("?!", "...", 0, 0, 0),
]


def test_worked_examples(spark):
    got = by_metric(rouge.rouge_scores(pairs_of(spark, *[c[:2] for c in CASES])))
    assert len(got) == 4 * len(CASES)
    for i, (*_, one, two, longest) in enumerate(CASES):
        assert got[i, "rouge1"].f1 == pytest.approx(one), CASES[i]
        assert got[i, "rouge2"].f1 == pytest.approx(two), CASES[i]
        assert got[i, "rougeL"].f1 == pytest.approx(longest), CASES[i]
        # Without line breaks a text is one sentence.
        assert got[i, "rougeLsum"].f1 == got[i, "rougeL"].f1


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def lcs_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table


def lcs_places(a, b):
    table, i, j, found = lcs_table(a, b), len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.append(i)
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def plain_hits(prediction, target):
    p, t = tokens(prediction), tokens(target)
    lines = [tokens(x) for x in target.split("\n")], [tokens(x) for x in prediction.split("\n")]
    left, right, union = Counter(p), Counter(t), 0
    for sentence in lines[0]:
        places = {k for other in lines[1] for k in lcs_places(sentence, other)}
        for word in (sentence[k] for k in places):
            if left[word] > 0 and right[word] > 0:
                left[word] -= 1
                right[word] -= 1
                union += 1
    grams = [Counter(zip(x, x[1:])) for x in (p, t)]
    return {
        "rouge1": sum((Counter(p) & Counter(t)).values()),
        "rouge2": sum((grams[0] & grams[1]).values()),
        "rougeL": lcs_table(p, t)[-1][-1],
        "rougeLsum": union,
    }


def random_texts(n, seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "d e", "F", "x9", "é", ",", "\n", "\n"]

    def text():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(25)))

    return [(text(), text()) for _ in range(n)]


def test_all_metrics_equal_brute_force(spark):
    texts = random_texts(300, 3)
    got = by_metric(rouge.rouge_scores(pairs_of(spark, *texts)))
    for i, (prediction, target) in enumerate(texts):
        n, m = len(tokens(prediction)), len(tokens(target))
        for metric, hits in plain_hits(prediction, target).items():
            row = got[i, metric]
            short = 1 if metric == "rouge2" else 0
            assert (row.hits, row.predicted, row.expected) == (
                hits, max(n - short, 0), max(m - short, 0)
            ), (metric, prediction, target)
            assert row.f1 == pytest.approx(
                2 * hits / (row.predicted + row.expected) if hits else 0
            )


def test_helpers_equal_brute_force_on_many_short_lists():
    rng = random.Random(11)
    for _ in range(3000):
        size = rng.choice([2, 3, 6])
        a = [str(rng.randrange(size)) for _ in range(rng.randrange(14))]
        b = [str(rng.randrange(size + 2)) for _ in range(rng.randrange(14))]
        assert overlap._lcs_length(a, b) == lcs_table(a, b)[-1][-1]
        assert overlap._lcs_positions(a, b, overlap._match_masks(b)) == lcs_places(a, b)


def test_properties(spark):
    texts = random_texts(80, 5)
    there = by_metric(rouge.rouge_scores(pairs_of(spark, *texts)))
    back = by_metric(rouge.rouge_scores(pairs_of(spark, *[(t, p) for p, t in texts])))
    self_scores = by_metric(rouge.rouge_scores(pairs_of(spark, *[(p, p) for p, _ in texts])))
    for i, (prediction, _) in enumerate(texts):
        for metric in ("rouge1", "rouge2", "rougeL"):
            assert there[i, metric].f1 == pytest.approx(back[i, metric].f1)
        assert there[i, "rougeL"].f1 <= there[i, "rouge1"].f1 + 1e-12
        if tokens(prediction):
            assert self_scores[i, "rouge1"].f1 == self_scores[i, "rougeL"].f1 == 1


def test_scoring_adds_no_exchange_to_the_join(spark):
    spark.range(50).select(F.col("id").alias("example_id"), F.lit("a b").alias("target")).createOrReplaceTempView("t")
    targets = spark.table("t")
    made = targets.select("example_id", F.lit("m").alias("model"), F.lit("a c").alias("prediction"))
    plan = plan_of(rouge.ngram_scores(rouge.pair_up(targets, made)))
    assert plan.count("Exchange hashpartitioning(example_id") == plan.count("Exchange") == 2
    assert "BroadcastExchange" not in plan


def test_ngrams_of_unrepeated_keys_are_counted_within_their_rows(spark):
    """The widest step makes a row per pair and metric, not one per n-gram."""
    words = [str(i) for i in range(500)]
    pairs = pairs_of(spark, *[(" ".join(words), " ".join(words[i:])) for i in range(20)])
    plain = rouge.ngram_scores(pairs)
    assert {(r.example_id, r.metric, r.hits) for r in plain.collect()} == {
        (i, m, 500 - i - short) for i in range(20) for m, short in (("rouge1", 0), ("rouge2", 1))
    }
    # ``collect`` runs the plan of ``plain`` itself, so its figures can be read off.
    rows = []
    nodes = [plain._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            nodes.append(node.plan())
            continue
        if node.metrics().contains("numOutputRows"):
            rows.append(node.metrics().apply("numOutputRows").value())
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
    assert 40 <= max(rows) <= 20 * 2 * 2


def test_repeated_pairs_are_scored_as_one_text(spark):
    rows = [
        (1, "m", "a b a", "a c"), (1, "m", "c d", "a b"), (1, "n", "a b", "a b"),
        (2, "m", "a b", "b a"), (2, "n", None, "x"),
        (None, "m", "q", "q r"), (None, "m", "r", "r"), (3, None, "a b", "a b"),
    ]
    pairs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.example_id, r.model, r.metric): (r.hits, r.predicted, r.expected) for r in rouge.ngram_scores(pairs).collect()}
    assert got == {
        (1, "m", "rouge1"): (4, 5, 4), (1, "m", "rouge2"): (1, 3, 2),
        (1, "n", "rouge1"): (2, 2, 2), (1, "n", "rouge2"): (1, 1, 1),
        (2, "m", "rouge1"): (2, 2, 2), (2, "m", "rouge2"): (0, 1, 1),
        (2, "n", "rouge1"): (0, 0, 1), (2, "n", "rouge2"): (0, 0, 0),
        (None, "m", "rouge1"): (2, 2, 3), (None, "m", "rouge2"): (0, 0, 1),
        (3, None, "rouge1"): (2, 2, 2), (3, None, "rouge2"): (1, 1, 1),
    }


def test_long_pair_of_one_example(spark):
    words = [str(i % 997) for i in range(20_000)]
    pairs = pairs_of(spark, (" ".join(words), " ".join(reversed(words))))
    got = by_metric(rouge.rouge_scores(pairs, ("rouge1", "rougeL")))
    assert got[0, "rouge1"].f1 == 1
    assert 0 < got[0, "rougeL"].f1 < 1


def test_corpus_scores_and_comparison(spark):
    scores = spark.createDataFrame(
        [(1, "base_model", "r1", 0.2), (2, "base_model", "r1", 0.4), (1, "fine_tuned_model", "r1", 0.5),
         (1, "base_model", "only", 0.1), (1, "fine_tuned_model", "another", 0.9)],
        "example_id long, model string, metric string, f1 double",
    )
    rows = comparing.compare_models(rouge.corpus_scores(scores)).collect()
    assert [r.metric for r in rows] == ["another", "only", "r1"]
    assert rows[2].delta == pytest.approx(0.2) and rows[2].base_model == pytest.approx(0.3)
    assert rows[0].base_model is None and rows[0].delta is None
    assert rows[1].fine_tuned_model is None and rows[1].delta is None


def test_alignment_counts_every_kind_of_mismatch(spark):
    targets = spark.createDataFrame([(i, "t") for i in range(4)], "example_id long, target string")
    made = spark.createDataFrame(
        [(0, "a", "x"), (1, "a", "x"), (1, "a", "y"), (9, "a", "z")]
        + [(i, "b", "x") for i in range(4)],
        "example_id long, model string, prediction string",
    )
    got = {r.model: tuple(r)[1:] for r in rouge.alignment(targets, made, ("a", "b", "c")).collect()}
    assert got == {"a": (2, 1, 1), "b": (0, 0, 0), "c": (4, 0, 0)}
    rouge.require_alignment(targets, made, ("b",))
    with pytest.raises(AlignmentError, match="2 targets without"):
        rouge.require_alignment(targets, made, ("a",))


def test_side_by_side_takes_fewer_rows_than_asked(spark):
    test = spark.createDataFrame([(2, "p2", "t2"), (1, "p1", "t1")], "example_id long, prompt string, target string")
    made = spark.createDataFrame(
        [(1, "base_model", "b1"), (1, "fine_tuned_model", "f1"), (2, "base_model", "b2"), (2, "fine_tuned_model", "f2")],
        "example_id long, model string, prediction string",
    )
    got = [tuple(r) for r in comparing.side_by_side(test, made, 5).collect()]
    assert got == [(1, "p1", "t1", "b1", "f1"), (2, "p2", "t2", "b2", "f2")]
    assert len(comparing.side_by_side(test, made, 1).collect()) == 1


def test_split_summary_lists_missing_splits(spark):
    sizes = spark.createDataFrame([("train", 3), ("test", 1)], "split string, rows long")
    planned = {"train": 0.8, "validation": 0.1, "test": 0.1}
    got = [tuple(r) for r in comparing.split_summary(sizes, "d", planned).collect()]
    assert got == [("d", "train", 0.8, 3, 0.75), ("d", "validation", 0.1, 0, 0.0), ("d", "test", 0.1, 1, 0.25)]


def test_prediction_is_cut_after_the_prompt(spark):
    frame = spark.createDataFrame(
        [("p+(", "p+(  new words here<|im_end|> "), ("q", "other text"), ("p", "p"), ("", " x ")],
        "prompt string, output string",
    )
    got = frame.select(clean_prediction(F.col("output"), F.col("prompt"), 3).alias("c")).collect()
    assert [r.c for r in got] == ["new words here", "other text", "", "x"]


def test_batch_predict_builds_one_generator_per_partition(spark, tmp_path):
    log = str(tmp_path / "made")

    def make():
        with open(log, "a") as file:
            file.write("x")
        return lambda prompts: [p + p.upper() for p in prompts]

    prompts = spark.range(40).select(F.col("id").alias("example_id"), F.concat(F.lit("w"), "id").alias("prompt"))
    made = batch_predict(prompts, make, "m", partitions=3)
    rows = made.collect()
    assert {(r.example_id, r.model, r.prediction) for r in rows} == {(i, "m", f"W{i}") for i in range(40)}
    assert 1 <= len(open(log).read()) <= 3


def test_batch_predict_cuts_prompts_and_checks_lengths(spark):
    prompts = spark.createDataFrame([(1, "a b c d e")], "example_id long, prompt string")
    row = batch_predict(prompts, lambda: lambda ps: [p + "|" + p for p in ps], "m", max_prompt_tokens=2).first()
    assert row.prediction == "|a b"
    with pytest.raises(Exception, match="0 outputs for 1 prompts"):
        batch_predict(prompts, lambda: lambda ps: [], "m").collect()


def test_profile_percentile_is_linear(spark, examples):
    rng = random.Random(2)
    texts = [(" ".join(["w"] * rng.randrange(60)), None, None) for _ in range(90)]
    lengths = sorted(len(t[0].split()) for t in texts)
    for sample in (None, 40):
        used = sorted(len(t[0].split()) for t in texts[:sample])
        got = profiling.length_profile(examples(*texts), sample).first()
        at = 0.95 * (len(used) - 1)
        low = int(at)
        expected = used[low] + (at - low) * (used[min(low + 1, len(used) - 1)] - used[low])
        assert got.p95_words == pytest.approx(expected)
        assert got.mean_words == pytest.approx(sum(used) / len(used))
        assert (got.n_rows, got.max_words) == (len(used), used[-1])
    assert lengths


def plain_summary(predicted, expected):
    """Union of line-wise LCS over all pairs of lines, none skipped."""
    left = Counter(t for line in predicted for t in line)
    hits = 0
    for line in expected:
        matched = set()
        for other in predicted:
            matched.update(overlap._lcs_positions(line, other, overlap._match_masks(other)))
        for i in sorted(matched):
            if left[line[i]] > 0:
                left[line[i]] -= 1
                hits += 1
    return hits


def test_indexed_lines_give_the_hits_of_all_pairs():
    rng = random.Random(6)
    for _ in range(200):
        words = [f"w{i}" for i in range(rng.randrange(1, 12))]
        sides = [
            [[rng.choice(words) for _ in range(rng.randrange(7))] for _ in range(rng.randrange(8))] for _ in range(2)
        ]
        assert overlap._summary_hits(*sides) == plain_summary(*sides)


def test_thousands_of_lines_take_seconds():
    rng = random.Random(7)
    words = ["the", "of", "and", *(f"w{i}" for i in range(3000))]
    lines = [[[*rng.choices(words[:3], k=2), *rng.choices(words, k=8)] for _ in range(5000)] for _ in range(2)]
    start = time.perf_counter()
    hits = overlap._summary_hits(*lines)
    assert time.perf_counter() - start < 40
    assert 0 < hits <= 50_000


def test_one_pass_equals_the_metrics_one_by_one(spark):
    texts = [("the cat\nsat on\n\nthe mat", "the mat\nsat the cat"), (None, "x"), ("a b a b", "b a b"), ("", None)]
    pairs = pairs_of(spark, *texts)
    alone = [rouge.ngram_scores(pairs), rouge.lcs_scores(pairs), rouge.summary_scores(pairs)]
    expected = sorted(tuple(r) for part in alone for r in part.select(*rouge.rouge_scores(pairs).columns).collect())
    assert sorted(map(tuple, rouge.rouge_scores(pairs).collect())) == expected
    assert rouge.rouge_scores(pairs, ("rougeL", "rouge1")).count() == 2 * len(texts)


def test_all_metrics_share_one_join_and_shuffle_nothing_else(spark):
    pairs = pairs_of(spark, ("a", "b"))
    paired = rouge.pair_up(pairs.select("example_id", "target"), pairs.select("example_id", "model", "prediction"))
    plan = plan_of(rouge.rouge_scores(paired))
    assert plan.count("SortMergeJoin") == 1 and plan.count("ArrowEvalPython") == 1
    assert plan.count("Exchange") == 2


def test_intervals(spark):
    """Resampled means lie around the plain mean, as far apart as the mean's standard error says."""
    rng = random.Random(3)
    rows = [(i, "m", "rouge1", rng.random()) for i in range(800)]
    scores = spark.createDataFrame(rows, "example_id long, model string, metric string, f1 double")
    resampled = rouge.resampled_scores(scores, 300)
    values = [r["value"] for r in resampled.where("draw > 0").collect()]
    mean = sum(r[3] for r in rows) / 800
    assert len(values) == 300 and len(set(values)) > 290
    spread = (sum((v - mean) ** 2 for v in values) / 300) ** 0.5
    assert spread == pytest.approx((sum((r[3] - mean) ** 2 for r in rows) / 800) ** 0.5 / 800**0.5, rel=0.15)
    row = rouge.corpus_intervals(resampled).first()
    assert row["value"] == pytest.approx(mean) and abs(row["mid"] - mean) < spread / 2
    assert mean - 2.5 * spread < row["low"] < mean - 1.4 * spread and mean + 1.4 * spread < row["high"] < mean + 2.5 * spread
    again = rouge.resampled_scores(scores.repartition(3), 300).where("draw = 7").first()["value"]
    assert again == pytest.approx(resampled.where("draw = 7").first()["value"])
    assert rouge.corpus_intervals(rouge.resampled_scores(scores.limit(0))).collect() == []
