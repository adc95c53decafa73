"""Periodic runs against brute force over all periods."""

import random
import time

import numpy as np
import pytest

from loomset.llm import runs

from .conftest import ODD_TEXTS


def plain_runs(words, least=12):
    """Every run: for each period, maximal stretches of words equal to the word one period on."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((start, length, q) for (start, length), q in found.items())


def listed(ids, least=12):
    return list(zip(*(part.tolist() for part in runs.find_runs(np.array(ids, np.int64), least))))


def by_start(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_random_sequences(letters):
    rng = random.Random(letters)
    for _ in range(150):
        ids = []
        while len(ids) < rng.randrange(1, 160):
            piece = [rng.randrange(letters) for _ in range(rng.randrange(1, 25))]
            ids += piece * rng.choice([1, 1, 2, 3, 7])
        for least in (8, 12):
            assert listed(ids, least) == by_start(plain_runs(ids, least))


def test_fibonacci_words_and_blocks_at_every_place():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert listed(b) == by_start(plain_runs(b))
    for shift in range(40):
        for period in (1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33):
            ids = [*range(100, 100 + shift), *[i % period for i in range(max(12, 2 * period))], *range(200, 207)]
            assert listed(ids) == by_start(plain_runs(ids))


def test_a_very_long_periodic_text_takes_seconds():
    start = time.perf_counter()
    one = runs.find_runs(np.zeros(400_000, np.int64))
    assert [part.tolist() for part in one] == [[0], [400_000], [1]]
    # Long equal stretches that are no squares: catches, but few, and no run across them.
    blocked = np.concatenate([np.r_[np.zeros(5000, np.int64), 1 + k] for k in range(40)])
    assert len(runs.find_runs(blocked)[0]) == 40
    assert time.perf_counter() - start < 30


def test_repeated_tail():
    words = [str(i).encode() for i in range(50)]
    assert runs.repeat_tail(words, 31) == words
    assert runs.repeat_tail([], 30) == []
    for crc in (10, 70, 123_450, 4_294_967_290):
        g = crc // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert runs.repeat_tail(words, crc) == words[:a] + [words[a + (i - a) % p] for i in range(a, 50)]


def test_rows_of_odd_texts(spark, documents):
    texts = [*ODD_TEXTS, "a b c d e f " * 3 + "tail", "x " + "ü ö " * 8]
    docs = documents(*((i, t) for i, t in enumerate(texts)), (None, "w " * 20), (1, texts[-1]), (1, texts[-1]))
    rows = runs.collapse_runs(docs.withColumnRenamed("kept", "runs"), docs.columns[:4] + ["runs"]).collect()
    assert len(rows) == docs.count()
    texts_of = {r["__row"]["doc_id"]: r for r in rows}
    for row in rows:
        words = (row["__row"]["text"] or "").encode().split()
        plain = by_start(plain_runs(words)) if len(words) < 2000 else [(0, 30_000, 1)]
        assert [tuple(r) for r in row["runs"]] == plain
        assert row["n_words"] == len(words)
        dropped = {i for start, length, q in plain for i in range(start + q, start + length)}
        assert bytes(row["collapsed"]) == b" ".join(w for i, w in enumerate(words) if i not in dropped)
    assert bytes(texts_of[len(ODD_TEXTS)]["collapsed"]) == b"a b c d e f tail"


def test_bytes_that_are_no_utf8_and_empty_tables(spark):
    odd = spark.sql("select 1 as doc_id, cast(unhex('FF20FE20') as string) as text")
    row = runs.collapse_runs(odd, ["doc_id"]).first()
    assert bytes(row["collapsed"]) == b"\xff \xfe" and row["n_words"] == 2
    assert runs.collapse_runs(odd.limit(0), ["doc_id"]).collect() == []
