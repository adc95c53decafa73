import json
import random

import pytest

from loomset.errors import DatasetLoadError
from loomset.sources import reader
from loomset.sources.arrays import array_as_lines

ODD = ["}", "{", '"', "\\", '\\"}', "[{", "},{", "a\nb", "ü中", "", "x" * 300, "\\\\", "]"]


def odd_rows(n, seed):
    pick = random.Random(seed)

    def text():
        return "".join(pick.choice(ODD) for _ in range(pick.randrange(4)))

    return [
        {
            "instruction": text(),
            "context": pick.choice([None, text()]),
            "response": text() + str(i),
            "more": {"deep": [{"v": text()} for _ in range(pick.randrange(3))], "n": i},
        }
        for i in range(n)
    ]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def as_set(rows):
    return sorted(json.dumps(row.asDict(recursive=True), sort_keys=True) for row in rows.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_same_rows_as_in_one_task(spark, tmp_path, small_blocks, monkeypatch, indent):
    path = str(tmp_path / "rows.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(odd_rows(150, 3), file, indent=indent, ensure_ascii=indent is None)
    whole = reader.load_rows(spark, path)
    monkeypatch.setattr(reader, "ARRAY_BYTES", 0)
    cut = reader.load_rows(spark, path, whole.schema)
    assert as_set(cut) == as_set(whole) and cut.count() == 150
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
    assert as_set(reader.load_rows(spark, path)) == as_set(whole)


def test_several_files_and_arrays_without_rows(spark, tmp_path, small_blocks):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate([odd_rows(20, 1), [], odd_rows(1, 2), [{}]]):
        (folder / f"{i}.json").write_text("\ufeff" * (i == 0) + " \n" + json.dumps(rows) + "\n\n", encoding="utf-8")
    lines = spark.read.text(array_as_lines(spark, str(folder), str(tmp_path / "out")))
    found = sorted(json.dumps(json.loads(r["value"]), sort_keys=True) for r in lines.collect())
    expected = odd_rows(20, 1) + odd_rows(1, 2) + [{}]
    assert found == sorted(json.dumps(row, sort_keys=True) for row in expected)


@pytest.mark.parametrize("text", ['[{"instruction": "a"}', '[{"instruction": "a"', '[{"instruction": "a}]', '[{"a": {"b": 1}]'])
def test_an_array_that_does_not_end_is_a_load_error(spark, tmp_path, monkeypatch, text):
    monkeypatch.setattr(reader, "ARRAY_BYTES", 0)
    path = tmp_path / "rows.json"
    path.write_text(text)
    with pytest.raises(DatasetLoadError):
        reader.load_rows(spark, str(path)).collect()


@pytest.mark.parametrize("text", ['[{"instruction": "a"} 7 {"instruction": "b"}]', '[{"instruction": "a"}, 7]', "[7]", '[{"a": 1} {"a": 2}]'])
def test_what_is_no_array_of_objects_is_a_load_error(spark, tmp_path, monkeypatch, text):
    monkeypatch.setattr(reader, "ARRAY_BYTES", 0)
    path = tmp_path / "rows.json"
    path.write_text(text)
    with pytest.raises(DatasetLoadError):
        with reader.loading(str(path)):
            reader.load_rows(spark, str(path)).collect()


def test_a_small_array_is_read_as_it_is(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[{"instruction": "a"}]')
    assert [name.rsplit("/", 1)[1] for name in reader.load_rows(spark, str(path)).inputFiles()] == ["rows.json"]
