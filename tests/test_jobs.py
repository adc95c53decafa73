import json
import os
import sys
from dataclasses import replace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomset import DatasetParams, EvaluationParams, JobParams, evaluate, explore, prepare
from loomset import prepare_rows, training_text
from loomset.errors import AlignmentError, ConfigError, EmptySplitError, MissingSplitError
from loomset.errors import DuplicateKeyError, SplitMismatchError, TooFewExamplesError
from loomset.functions.tokens import token_count
from loomset.operators.comparing import BASE, TUNED
from loomset.operators.splitting import split_rows
from loomset.plans.evaluate import generator_name, table_name
from loomset.sources.reader import load_splits
from loomset.sources.storage import exists

prepare_module = sys.modules["loomset.plans.prepare"]
# Executors do not import test modules, so the generators below travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows_of(spark, n, long_every=0):
    text = F.lit("word ").cast("string")
    long = F.when(F.lit(long_every) > 0, F.col("id") % F.lit(max(long_every, 1)) == 0).otherwise(False)
    return spark.range(n).select(
        F.col("id").alias("row"),
        F.concat(F.lit("question "), F.col("id").cast("string")).alias("instruction"),
        F.lit(None).cast("string").alias("context"),
        F.when(long, F.repeat(text, 100)).otherwise(F.concat(F.lit("answer "), F.col("id").cast("string"))).alias("response"),
        F.lit(None).cast("string").alias("output"),
    )


def params(tmp_path, **changes):
    given = {"min_examples": 10, "max_seq_length": 60, "key": "row"} | changes
    return DatasetParams("rows", str(tmp_path / "splits"), **given)


def test_prepare_end_to_end(spark, tmp_path):
    done = prepare_rows(rows_of(spark, 110, long_every=11), params(tmp_path))
    sizes = {r["split"]: r["count"] for r in done.groupBy("split").count().collect()}
    assert sizes == {"train": 80, "validation": 10, "test": 10}
    assert set(done.columns) == {
        "row", "example_id", "instruction", "context", "response", "output",
        "text", "prompt", "target", "split",
    }
    assert done.select("example_id").distinct().count() == 100
    assert done.where("row % 11 = 0").count() == 0
    assert not list((tmp_path).glob("**/num_tokens*"))


def test_prepare_without_key_and_with_copies(spark, tmp_path):
    rows_of(spark, 60).drop("row").write.parquet(str(tmp_path / "a.parquet"))
    hot = spark.createDataFrame([("same", "", "answer", None)] * 40, rows_of(spark, 1).drop("row").schema)
    hot.write.mode("append").parquet(str(tmp_path / "a.parquet"))
    given = params(tmp_path, key=None, keep_source=False)
    given = DatasetParams(**{**given.__dict__, "name_or_path": str(tmp_path / "a.parquet")})
    done = prepare(spark, given)
    assert set(done.columns) == {"example_id", "text", "prompt", "target", "split"}
    assert done.count() == 100 == done.select("example_id").distinct().count()
    assert done.where("target = 'answer'").count() == 40


def test_named_template(spark, tmp_path):
    done = prepare_rows(rows_of(spark, 20), params(tmp_path, template="phi3", max_seq_length=500))
    assert done.where("text like '<|system|>%<|endoftext|>'").count() == 20


def test_every_way_of_dropping_long_rows_gives_the_same_splits(spark, tmp_path, monkeypatch):
    rows = rows_of(spark, 110, long_every=11)
    results = []
    for name, few, reuse in (("broadcast", 10, False), ("recount", 9, False), ("join", 9, True)):
        monkeypatch.setattr(prepare_module, "BROADCAST_ROWS", few)
        done = prepare_rows(rows, params(tmp_path / name), token_count, reuse)
        assert "_hash" not in done.columns
        results.append(sorted(map(tuple, done.select("row", "split", "text").collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 100


def test_finished_splits_are_kept_unless_forced(spark, tmp_path):
    rows_of(spark, 50).write.parquet(str(tmp_path / "a.parquet"))
    given = DatasetParams(str(tmp_path / "a.parquet"), str(tmp_path / "s"), min_examples=10, key="row")
    assert prepare(spark, given).count() == 50
    rows_of(spark, 60).write.mode("overwrite").parquet(str(tmp_path / "a.parquet"))
    assert prepare(spark, given).count() == 50
    (tmp_path / "s" / "_commits" / "00000001.json").unlink()
    assert prepare(spark, given).count() == 60
    rows_of(spark, 70).write.mode("overwrite").parquet(str(tmp_path / "a.parquet"))
    assert prepare(spark, given, force=True).count() == 70


def test_minimum_before_and_after_the_filter(spark, tmp_path):
    rows = rows_of(spark, 40, long_every=8)
    with pytest.raises(TooFewExamplesError, match="40 examples in the dataset"):
        prepare_rows(rows, params(tmp_path, min_examples=41))
    with pytest.raises(TooFewExamplesError, match="35 examples after length filtering"):
        prepare_rows(rows, params(tmp_path, min_examples=36))
    assert prepare_rows(rows, params(tmp_path, min_examples=35)).count() == 35


def test_scratch_is_removed_also_after_an_error(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir") + "/loomset"

    def listing():
        return {name for name in os.listdir(root) if name.startswith("keys")}

    prepare_rows(rows_of(spark, 20), params(tmp_path))
    before = listing()
    with pytest.raises(TooFewExamplesError):
        prepare_rows(rows_of(spark, 5), params(tmp_path / "x"))
    assert listing() == before == set()


def test_unequal_passes_are_noticed(spark, tmp_path):
    out = str(tmp_path / "s")
    prepare_rows(rows_of(spark, 50), params(tmp_path, min_examples=1))
    written = str(tmp_path / "splits")
    planned = {"train": 40, "validation": 5, "test": 5}
    done = load_splits(spark, written)
    prepare_module._check_written(done, planned, {"train": 41, "validation": 5, "test": 5})
    with pytest.raises(SplitMismatchError):
        prepare_module._check_written(done, planned | {"train": 39}, planned)
    assert not exists(spark, out)


def test_refused_splits_are_not_served_later(spark, tmp_path, monkeypatch):
    rows_of(spark, 50).write.parquet(str(tmp_path / "a.parquet"))
    given = DatasetParams(str(tmp_path / "a.parquet"), str(tmp_path / "s"), min_examples=10, key="row")

    def refuse(*_):
        raise SplitMismatchError("changed")

    with monkeypatch.context() as patched:
        patched.setattr(prepare_module, "_check_written", refuse)
        for _ in range(2):
            with pytest.raises(SplitMismatchError):
                prepare(spark, given)
    with pytest.raises(MissingSplitError):
        load_splits(spark, given.processed_dir)
    assert prepare(spark, given).count() == 50


def test_other_parameters_redo_the_splits(spark, tmp_path):
    rows_of(spark, 50, long_every=5).write.parquet(str(tmp_path / "a.parquet"))
    given = DatasetParams(str(tmp_path / "a.parquet"), str(tmp_path / "s"), min_examples=10, key="row")
    assert prepare(spark, given).count() == 50
    assert prepare(spark, replace(given, max_seq_length=60)).count() == 40


@pytest.mark.parametrize("few, reuse", [(100, False), (0, False), (0, True)])
def test_repeated_keys_are_refused_on_every_way(spark, tmp_path, monkeypatch, few, reuse):
    monkeypatch.setattr(prepare_module, "BROADCAST_ROWS", few)
    twice = rows_of(spark, 50, long_every=10).union(rows_of(spark, 1, long_every=2))
    with pytest.raises(DuplicateKeyError, match="2 rows share one example_id"):
        prepare_rows(twice, params(tmp_path), reuse_counts=reuse)
    with pytest.raises(DuplicateKeyError, match="2 rows share one example_id"):
        split_rows(twice.withColumnRenamed("row", "example_id"), 0.1, 0.1, 42)


def test_training_text(spark, tmp_path):
    given = params(tmp_path)
    with pytest.raises(MissingSplitError):
        training_text(spark, given)
    prepare_rows(rows_of(spark, 50), given)
    texts = training_text(spark, given)
    assert {n: (t.columns, t.count()) for n, t in texts.items()} == {
        "train": (["text"], 40),
        "validation": (["text"], 5),
    }
    plan = texts["train"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
    tiny = params(tmp_path / "tiny", min_examples=1)
    prepare_rows(rows_of(spark, 1), tiny)
    with pytest.raises(EmptySplitError, match="train=0, validation=0"):
        training_text(spark, tiny)


def repeat_question():
    return lambda prompts: [p + p.split("\n")[3] for p in prompts]


def answers():
    return lambda prompts: [p + "answer" for p in prompts]


def job(tmp_path, **changes):
    return JobParams(params(tmp_path), EvaluationParams(str(tmp_path / "results"), **{"buckets": 1} | changes))


def test_evaluate_end_to_end(spark, tmp_path):
    given = job(tmp_path)
    with pytest.raises(MissingSplitError):
        evaluate(spark, given, {BASE: repeat_question, TUNED: answers})
    prepare_rows(rows_of(spark, 50), given.dataset)
    result = evaluate(spark, given, {BASE: repeat_question, TUNED: answers})
    values = {(r.model, r.metric): r.value for r in result.scores.collect()}
    assert len(values) == 8
    # Targets are "answer <n>"; the base model repeats "question <n>".
    assert values[TUNED, "rouge1"] == pytest.approx(2 / 3)
    assert values[TUNED, "rouge2"] == 0
    assert values[BASE, "rougeL"] == values[BASE, "rouge1"] == pytest.approx(0.5)
    compared = result.comparison.collect()
    assert sorted(r.metric for r in compared) == ["rouge1", "rouge2", "rougeL", "rougeLsum"]
    for row in compared:
        assert row.delta == pytest.approx(row[TUNED] - row[BASE])
    summary = {r.split: (r.dataset, r.planned_share, r.rows, r.actual_share) for r in result.summary.collect()}
    assert summary == {
        "train": ("rows", 0.8, 40, 0.8), "validation": ("rows", 0.1, 5, 0.1), "test": ("rows", 0.1, 5, 0.1),
    }
    shown = result.examples.orderBy("example_id").collect()
    test_rows = load_splits(spark, given.dataset.processed_dir).where("split = 'test'")
    first = test_rows.orderBy("example_id").limit(5).collect()
    assert [r.prompt for r in shown] == [r.prompt for r in first]
    assert [r.ground_truth for r in shown] == [r.target for r in first]
    assert {r.fine_tuned_response for r in shown} == {"answer"}


def test_results_and_report_are_kept(spark, tmp_path):
    given = job(tmp_path, metrics=("rouge1",), report_path=str(tmp_path / "report"))
    prepare_rows(rows_of(spark, 50), given.dataset)
    first = evaluate(spark, given, {BASE: repeat_question, TUNED: answers}).scores.collect()
    kept = evaluate(spark, given, {BASE: repeat_question, TUNED: answers}).scores.collect()
    assert sorted(map(tuple, kept)) == sorted(map(tuple, first))
    report = [json.loads(t) for f in (tmp_path / "report" / "comparison").glob("*.json") for t in f.read_text().splitlines()]
    redone = evaluate(spark, given, {BASE: answers, TUNED: answers}, force=True)
    assert [r.value for r in redone.scores.collect()] == pytest.approx([2 / 3] * 2)
    after = [json.loads(t) for f in (tmp_path / "report" / "comparison").glob("*.json") for t in f.read_text().splitlines()]
    assert after == report
    assert [(r[BASE], r[TUNED], r.delta) for r in redone.comparison.collect()] == [pytest.approx((2 / 3, 2 / 3, 0))]


def test_other_metrics_and_other_splits_are_computed(spark, tmp_path):
    given = job(tmp_path, metrics=("rouge1",))
    prepare_rows(rows_of(spark, 50), given.dataset)
    assert evaluate(spark, given, {BASE: answers, TUNED: answers}).scores.count() == 2
    more = evaluate(spark, job(tmp_path), {BASE: repeat_question, TUNED: repeat_question}).scores.collect()
    values = {(r.model, r.metric): r.value for r in more}
    assert len(values) == 8 and values[BASE, "rouge1"] == 0.5
    prepare_rows(rows_of(spark, 50), given.dataset)
    again = evaluate(spark, job(tmp_path), {BASE: repeat_question, TUNED: repeat_question}).scores.collect()
    assert {r.value for r in again if r.metric == "rouge1"} == {0.5}


def values_of(result):
    return {(r.model, r.metric): r.value for r in result.scores.collect()}


def test_scores_are_those_of_what_was_given(spark, tmp_path):
    """Unforced calls with other predictions or generators must not return earlier scores."""
    given = job(tmp_path, metrics=("rouge1",))
    prepare_rows(rows_of(spark, 50), given.dataset)
    test = load_splits(spark, given.dataset.processed_dir).where("split = 'test'")
    both = F.explode(F.array(F.lit(BASE), F.lit(TUNED)))
    right = test.select("example_id", both.alias("model"), F.col("target").alias("prediction"))
    assert set(values_of(evaluate(spark, given, predictions=right)).values()) == {1.0}
    halves = values_of(evaluate(spark, given, {BASE: repeat_question, TUNED: answers}))
    assert halves == {(BASE, "rouge1"): 0.5, (TUNED, "rouge1"): pytest.approx(2 / 3)}
    assert values_of(evaluate(spark, given, {BASE: answers, TUNED: answers}))[BASE, "rouge1"] == pytest.approx(2 / 3)
    assert set(values_of(evaluate(spark, given, predictions=right)).values()) == {1.0}
    wrong = right.withColumn("prediction", F.lit("nothing"))
    assert set(values_of(evaluate(spark, given, predictions=wrong)).values()) == {0.0}


def test_generators_are_told_apart_by_what_they_hold():
    def made(word):
        return lambda: lambda prompts: [word] * len(prompts)

    one, other = generator_name(made("x")), generator_name(made("y"))
    assert one != other and one == generator_name(made("x"))
    assert generator_name(answers) != generator_name(answers, "2") != generator_name(repeat_question, "2")


def test_equal_tables_are_not_scored_again(spark, tmp_path):
    given = job(tmp_path, metrics=("rouge1",))
    prepare_rows(rows_of(spark, 50), given.dataset)
    test = load_splits(spark, given.dataset.processed_dir).where("split = 'test'")
    made = test.select("example_id", F.explode(F.array(F.lit(BASE), F.lit(TUNED))).alias("model"), F.lit("answer").alias("prediction"))
    evaluate(spark, given, predictions=made)
    stamp = os.stat(tmp_path / "results" / "metrics" / "_SUCCESS").st_mtime_ns
    evaluate(spark, given, predictions=made.orderBy("model"))
    assert os.stat(tmp_path / "results" / "metrics" / "_SUCCESS").st_mtime_ns == stamp
    assert table_name(made) == table_name(made.repartition(3)) != table_name(made.union(made))


def test_inference_goes_on_where_it_stopped(spark, tmp_path):
    """A generator that fails half-way is not asked again for finished prompts."""
    given = job(tmp_path, metrics=("rouge1",), buckets=4, partitions=1)
    prepare_rows(rows_of(spark, 200), given.dataset)
    log, broken = tmp_path / "asked", tmp_path / "broken"
    broken.write_text("")

    def careful():
        def generate(prompts):
            if broken.exists() and log.exists() and len(log.read_text().splitlines()) > 8:
                raise RuntimeError("out of memory")
            with log.open("a") as file:
                file.writelines(p.split("\n")[3] + "\n" for p in prompts)
            return [p + "answer" for p in prompts]

        return generate

    generators = {BASE: careful, TUNED: answers}
    with pytest.raises(Exception, match="out of memory"):
        evaluate(spark, given, generators)
    done = [d for d in (tmp_path / "results" / "predictions" / BASE).iterdir() if (d / "_SUCCESS").exists()]
    kept = {r.example_id for d in done for r in spark.read.parquet(str(d)).collect()}
    assert 1 <= len(done) < 4 and kept
    broken.unlink()
    log.unlink()
    assert values_of(evaluate(spark, given, generators))[BASE, "rouge1"] == pytest.approx(2 / 3)
    asked = log.read_text().splitlines()
    assert len(asked) == 20 - len(kept) and len(set(asked)) == len(asked)


def test_intervals_stand_around_the_scores(spark, tmp_path):
    given = job(tmp_path, metrics=("rouge1",))
    prepare_rows(rows_of(spark, 50), given.dataset)
    result = evaluate(spark, given, {BASE: repeat_question, TUNED: answers})
    for row in result.intervals.collect():
        assert row.low <= row.mid <= row.high and row.value == pytest.approx(values_of(result)[row.model, "rouge1"])
    none = evaluate(spark, job(tmp_path, metrics=("rouge1",), resamples=0), {BASE: repeat_question, TUNED: answers})
    assert [(r.low, r.high) for r in none.intervals.collect()] == [(None, None)] * 2


def test_test_file(spark, tmp_path):
    file = tmp_path / "test.jsonl"
    file.write_text("".join(json.dumps({"prompt": f"p{i}", "target": f"answer {i}", "id": i}) + "\n" for i in range(4)))
    given = JobParams(params(tmp_path), EvaluationParams(str(tmp_path / "r"), test_file=str(file), metrics=("rouge1",)))
    result = evaluate(spark, given, {BASE: answers, TUNED: answers})
    assert [r.value for r in result.scores.collect()] == pytest.approx([2 / 3] * 2)
    assert [(r.split, r.rows) for r in result.summary.where("rows > 0").collect()] == [("test", 4)]
    with pytest.raises(MissingSplitError):
        evaluate(spark, replace(given, evaluation=replace(given.evaluation, test_file=str(tmp_path / "no.jsonl"))), {BASE: answers, TUNED: answers})


def test_supplied_predictions_must_pair_up(spark, tmp_path):
    given = job(tmp_path, metrics=("rouge1",))
    prepare_rows(rows_of(spark, 50), given.dataset)
    test = load_splits(spark, given.dataset.processed_dir).where("split = 'test'")
    made = test.select("example_id", F.explode(F.array(F.lit(BASE), F.lit(TUNED))).alias("model"))
    made = made.withColumn("prediction", F.lit("answer"))
    one = test.select(F.min("example_id").alias("m")).first().m
    for broken in (made.where((F.col("model") == BASE) | (F.col("example_id") != one)), made.union(made.limit(1))):
        with pytest.raises(AlignmentError):
            evaluate(spark, given, predictions=broken)
    assert evaluate(spark, given, predictions=made).scores.count() == 2
    with pytest.raises(AlignmentError, match="other_model"):
        evaluate(spark, given, predictions=made.union(made.limit(1).withColumn("model", F.lit("other_model"))))


def test_empty_test_split(spark, tmp_path):
    given = JobParams(
        params(tmp_path, train_split=0.5, val_split=0.5, test_split=0.0),
        EvaluationParams(str(tmp_path / "results")),
    )
    prepare_rows(rows_of(spark, 20), given.dataset)
    with pytest.raises(EmptySplitError, match="test=0"):
        evaluate(spark, given, {BASE: repeat_question, TUNED: answers})


def test_explore_without_a_key_writes_nothing(spark, examples):
    root = spark.conf.get("spark.checkpoint.dir") + "/loomset"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    profile = explore(examples(("a b", "c", "d"), ("a b", "c", "d"), ("x", None, None), keyed=False), sample=2)
    assert (profile.rows, profile.word_lengths.first().n_rows, profile.preview.count()) == (3, 2, 1)
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


def test_explore(spark, examples):
    profile = explore(examples(("a b", "c", "d"), ("x", None, None)), key="example_id")
    lengths = profile.word_lengths.first()
    assert profile.rows == 2
    assert (lengths.n_rows, lengths.mean_words, lengths.max_words) == (2, 1.5, 2)
    assert lengths.p95_words == pytest.approx(1.95)
    shown = profile.preview.collect()
    assert len(shown) == 1 and shown[0].example_id == 0 and shown[0].text.endswith("d<|im_end|>")


def test_parameters(tmp_path):
    config = {
        "dataset": {"name_or_path": "x", "processed_dir": "y", "seed": 7},
        "evaluation": {"results_dir": "r", "metrics": ["rouge"]},
        "lora": {"r": 16},
    }
    file = tmp_path / "job.json"
    file.write_text(json.dumps(config))
    read = JobParams.from_file(str(file))
    assert read.dataset.seed == 7 and read.dataset.max_seq_length == 2048
    assert read.dataset.min_examples == 1000 and read.ignored == ("lora",)
    assert read.evaluation.metrics == ("rouge1", "rouge2", "rougeL", "rougeLsum")
    for section, key, value in [
        ("dataset", "sed", 1),
        ("dataset", "val_split", 0.2),
        ("dataset", "template", "nope"),
        ("evaluation", "metrics", ["bleu"]),
        ("evaluation", "metrics", []),
    ]:
        with pytest.raises(ConfigError):
            JobParams.from_mapping(config | {section: config[section] | {key: value}})
    with pytest.raises(ConfigError, match="extra"):
        JobParams.from_mapping(config | {"extra": {}})
    with pytest.raises(ConfigError, match="required"):
        JobParams.from_mapping({})


def test_yaml_parameters(tmp_path):
    pytest.importorskip("yaml")
    file = tmp_path / "job.yaml"
    file.write_text("dataset:\n  name_or_path: x\n  processed_dir: y\n  template: phi3\n")
    assert JobParams.from_file(str(file)).dataset.chat_template.name == "phi3"


def test_command_line(spark, tmp_path, capsys):
    from loomset.__main__ import main

    rows_of(spark, 50).write.parquet(str(tmp_path / "a.parquet"))
    file = tmp_path / "job.json"
    file.write_text(json.dumps({
        "dataset": {
            "name_or_path": str(tmp_path / "a.parquet"), "processed_dir": str(tmp_path / "s"),
            "min_examples": 10, "key": "row",
        },
        "evaluation": {"results_dir": str(tmp_path / "r"), "metrics": ["rouge1"]},
    }))
    echo = "loomset.registry.adapters:make_echo"
    main(["explore", "--config", str(file)])
    main(["prepare", "--config", str(file)])
    main(["training-text", "--config", str(file)])
    main(["evaluate", "--config", str(file), "--base", echo, "--tuned", echo])
    shown = capsys.readouterr().out
    assert "validation|    5" in shown and "rouge1" in shown
