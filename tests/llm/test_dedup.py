import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

from loomset.llm import exact_dedup, simhash

from .conftest import ODD_TEXTS


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(keys, prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    label = keys.copy()
    while True:
        new = np.where(near, label[None], 1 << 60).min(1)
        if (new == label).all():
            return label
        label = new


def test_grace_spills_and_compares_whole_contents():
    rng = random.Random(1)
    records = [(bytes([rng.randrange(40)]) * rng.randrange(1, 60), i) for i in range(3000)]
    expected = {}
    for content, tag in records:
        expected.setdefault(content, []).append(tag)
    for limit in (200, 5_000, 1 << 20):
        found = dict(exact_dedup.grace_groups(iter(records), limit))
        assert {c: sorted(t) for c, t in found.items()} == expected


def test_equal_hashes_of_different_contents_stay_apart():
    table = exact_dedup.ContentTable(4)
    assert [table.find_or_add(c, 7) for c in (b"a", b"b", b"a", b"c", b"d", b"b")] == [0, 1, 0, 2, 3, 1]


def test_exact_copies(spark, documents):
    docs = documents(*((i % 9, ODD_TEXTS[i % len(ODD_TEXTS)]) for i in range(40)), (None, "a"), (None, "only"), (None, "only"))
    rows = exact_dedup.find_copies(docs.repartition(5), table_bytes=100).collect()
    groups = {}
    for key, text in docs.select("doc_id", "text").collect():
        groups.setdefault(hashlib.sha256((text or "").encode()).hexdigest(), []).append(key)
    assert len(rows) == 43
    for digest, keys in groups.items():
        own = [r for r in rows if r.text_sha256 == digest]
        best = max((k for k in keys if k is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in own} == {(best, len(keys))}
        assert [r.doc_id for r in own if r.kept] == [best]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_empty_tables(documents):
    empty = documents((1, "x")).where("false")
    assert exact_dedup.find_copies(empty).count() == exact_dedup.drop_copies(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == simhash.drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("text", [t for t in ODD_TEXTS if t is None or len(t) < 1000])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_print(text)


def test_tiles_lose_no_link():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    near = [p ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(1, 5), False)) for p in prints[:200]]
    every = np.unique(np.concatenate([prints, np.array(near, np.uint64)]))
    links = simhash.compare_tiles(every[:300], every[300:], block=16)
    a, b = np.nonzero(np.triu(np.bitwise_count(every[:300, None] ^ every[None]) <= 3, 1))
    position = {int(v): i for i, v in enumerate(every.view(np.int64).tolist())}
    found = simhash.Forest(len(every))
    found.join(np.array([position[x] for x, _ in links]), np.array([position[y] for _, y in links]))
    assert len(a) and (found.label[a] == found.label[b]).all()
    assert len(found.links) == len(links)


@pytest.mark.parametrize("chunk", [7, 60, 1 << 17])
def test_large_tiles_are_dealt_into_bounded_pieces(spark, chunk):
    rng = np.random.default_rng(8)
    # Half of them share one tile: four quarters of eight bits each.
    quarter = np.array([x for x in range(1 << 16) if x.bit_count() == 8], np.uint64)
    one = sum(rng.choice(quarter, 300).astype(np.uint64) << np.uint64(16 * k) for k in range(4))
    near = [p ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(1, 4), False)) for p in one]
    every = np.unique(np.concatenate([one, np.array(near, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]))
    prints = spark.createDataFrame([(p,) for p in every.view(np.int64).tolist()], "print long").repartition(3)
    found = simhash.Forest(len(every))
    position = {p: i for i, p in enumerate(every.view(np.int64).tolist())}
    pairs = [(position[r.a], position[r.b]) for r in simhash.link_forest(prints, 3, chunk).collect()]
    found.join(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    expected = simhash.Forest(len(every))
    expected.join(*np.nonzero(np.bitwise_count(every[:, None] ^ every[None]) <= 3))
    assert all(np.bitwise_count(every[a] ^ every[b]) <= 3 for a, b in pairs)
    assert found.label.tolist() == expected.label.tolist()
    tiles, chunks = simhash._occupied_tiles(prints, 3, chunk)
    batch = pa.record_batch({"print": every.view(np.int64)})
    cells = pd.concat(b.to_pandas() for b in simhash._to_tiles(iter([batch]), 3, tiles, chunks))
    assert cells.groupby(["cell", "host"]).size().max() <= 4 * chunk
    assert (chunks.max() > 1) == (chunk < 100)
    assert cells.groupby("cell")["host"].any().mean() > 0.9


def test_components_equal_brute_force(spark, documents):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(400)) for _ in range(12)]
    texts = [*ODD_TEXTS]
    for text in base:
        words = text.split()
        for _ in range(6):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
            texts.append(" ".join(words))
    docs = documents(*((500 - i, t) for i, t in enumerate(texts)))
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = np.array([plain_print(t) for t in texts], np.uint64)
    keys = np.array([500 - i for i in range(len(texts))])
    expected = plain_components(keys, prints)
    assert [rows[k].fingerprint for k in keys] == [format(int(p), "016x") for p in prints]
    assert [rows[k].component_id for k in keys] == expected.tolist()
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.tolist()))


def test_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    rows = {r.node: r.root for r in simhash.components(chain).collect()}
    assert rows == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_rows_that_share_a_key(documents):
    docs = documents((1, "a b c d"), (1, "e f g h"), (None, "a b c d"), (None, "i j k l"), (None, "m n o p"))
    assert simhash.drop_near_copies(docs).count() == 4


def test_tables_hold_what_they_may():
    """Short contents and repeated keys count too: the table, not only its texts, is bounded."""
    import tracemalloc

    limit = 8 << 20
    for records in (((b"%d" % i, i) for i in range(200_000)), ((b"%d" % (i % 50), i) for i in range(300_000))):
        tracemalloc.start()
        total = sum(len(tags) for _, tags in exact_dedup.grace_groups(records, limit))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert total in (200_000, 300_000) and peak < 2.5 * limit
