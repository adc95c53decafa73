"""Collocations against brute force, with routes of every depth, and the sort by itself."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash

from loomset.llm import collocations as co

from .conftest import ODD_TEXTS


def plain(rows, most=3, least=10, top=2000):
    """The contract, word by word. Rows: (lang, text)."""
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        low = re.sub(r"[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in frequent.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(
                len(q) > len(p) and 100 * c >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, c in frequent.items()
            ):
                continue
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in co.mine(docs, **options).collect())


def made(seed, n=90):
    rng = random.Random(seed)
    words = ["a", "B", "c-d", "ÄÖ", "new", "York", "new York", "the", "of", "x" * 40, "日本", "e f", "g\x1ch"]
    words += ["in fact", "as well as", "Zum Beispiel", "w1 w2 w3 w4", "of the", *(f"k{i}" for i in range(20))]
    signs = [" "] * 30 + ["\t", ". ", ", ", "\n", "\r\n", "! ", "\x0b"]
    for _ in range(n):
        yield rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randrange(160)))


@pytest.mark.parametrize("fanout", [1 << 17, 100, 1])
def test_equals_brute_force(spark, documents, fanout):
    """A large fan-out sends words and pairs into deeper routes; small portions cut texts."""
    rows = [*made(1), *((None, t) for t in ODD_TEXTS if t is None or len(t) < 1000), ("en", "The the THE " * 300)]
    docs = documents(*((i, t, lang) for i, (lang, t) in enumerate(rows)))
    expected = plain(rows)
    assert len(expected) > 20
    assert found(docs, fanout=fanout, size=50 if fanout == 100 else 1 << 18) == expected


def test_longer_phrases_fewer_ranks_and_other_minima(spark, documents):
    rows = list(made(2))
    docs = documents(*((i, t, lang) for i, (lang, t) in enumerate(rows)))
    for most, least, top in ((2, 3, 7), (4, 5, 2000)):
        assert found(docs, most=most, least=least, top=top, fanout=200) == plain(rows, most, least, top)


def test_one_phrase_is_a_third_of_all(spark, documents):
    rows = [("en", " ".join(f"hot pair w{i} x{i % 50}" for i in range(k, k + 400))) for k in range(0, 2000, 400)]
    docs = documents(*((i, t, lang) for i, (lang, t) in enumerate(rows)))
    assert found(docs, fanout=80, size=300) == plain(rows)


def test_large_products_are_exact(spark):
    """Counts near the decimals' limit: the division must not round."""
    rows = spark.createDataFrame([(10**12 - 1, 10**15 - 1, 10**15 - 7)], "a long, l long, r long")
    cells = rows.selectExpr(
        "cast(1000000 as decimal(7,0)) * (cast(a as decimal(12,0)) * cast(a as decimal(12,0))) as over",
        "cast(l as decimal(15,0)) * cast(r as decimal(15,0)) as under",
    )
    a, left, right = 10**12 - 1, 10**15 - 1, 10**15 - 7
    assert cells.selectExpr("over div under").first()[0] == 1_000_000 * a * a // (left * right)


def test_word_hashes_and_bits_are_those_of_the_table(spark):
    rows = spark.createDataFrame([("en", b"abc", 10), ("und", "ü".encode(), 11), ("x" * 40, b"y" * 99, 9)], "lang string, w1 binary, n long")
    hashed = rows.selectExpr("lang", "w1", "n", "xxhash64(lang, w1) as h").collect()
    assert all(xxhash.xxh64_intdigest(bytes(r["w1"]), co.lang_seed(r["lang"])) == r["h"] % (1 << 64) for r in hashed)
    table = co.frequent_bits(rows, 10, 1 << 16)
    places = {r["h"] % (1 << 16) for r in hashed if r["n"] >= 10}
    assert set(np.flatnonzero(np.unpackbits(table, bitorder="little")).tolist()) == places


def test_a_full_bitmap_only_keeps_more(spark, documents):
    rows = list(made(3, 30))
    docs = documents(*((i, t, lang) for i, (lang, t) in enumerate(rows))).select("lang", "text")
    words = co.count_words(docs)
    total = words.agg({"n": "sum"}).first()[0]
    few = co.count_phrases(docs, words, total, bits=1 << 15).collect()
    many = co.count_phrases(docs, words, total).collect()
    assert sorted(few) == sorted(many) and few


@pytest.mark.parametrize("small", [0, 1, 30, 1000])
def test_sorting_counts_equal_partitions(small):
    rng = np.random.default_rng(4)
    for least in (1, 3, 10):
        keys = [rng.integers(0, k, 500) for k in (2, 5, 9)]
        keys[2][rng.random(500) < 0.2] = -1
        weight = rng.integers(1, 4, 500)
        got = {}
        for depth, pointers, found_counts in co.sort_pointers(keys, weight, least, small):
            for pointer, count in zip(pointers, found_counts):
                prefix = tuple(int(keys[d][pointer]) for d in range(depth + 1))
                assert prefix not in got
                got[prefix] = count
        counts = collections.Counter()
        for i in range(500):
            for depth in range(3):
                prefix = tuple(int(keys[d][i]) for d in range(depth + 1))
                if prefix[-1] >= 0:
                    counts[prefix] += int(weight[i])
        assert got == {p: c for p, c in counts.items() if c >= least}


def test_bytes_that_are_no_utf8_and_empty_tables(spark):
    odd = spark.sql("select 'en' as lang, cast(unhex(repeat('FF20FE20', 12)) as string) as text")
    rows = co.mine(odd).selectExpr("hex(phrase) as phrase", "a", "n").collect()
    assert sorted(tuple(r) for r in rows) == [("FE20FF20FE", 11, 24), ("FF20FE20FF", 11, 24)]
    assert co.mine(odd.limit(0)).collect() == []
