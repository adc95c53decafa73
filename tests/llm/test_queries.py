"""Every numbered query and the pipeline through the contract: names, types, remainders, brute force."""

import base64
import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from loomset.llm import runs
from loomset.llm.common import table
from loomset.llm.queries import QUERIES
from loomset.llm.subwords import WordEncoder, vocabulary_path

from .test_models import plain_counts
from .test_runs import by_start, plain_runs

BASE = "/root/testdata/sf0.001"
#: Enough labels for the toxicity model to reject something.
LARGER = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_mix_sources": "doc_id size source_size target taken",
    "op7_shard_documents": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op9_warc_archive": "page_id payload_bytes payload_digest record_type refers_to",
    "op10_language_id": "doc_id held_out lang_pred score",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_quality_classifier": "doc_id held_out score predicted",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}
OTHERS = {
    "held_out": "boolean", "base_failed": "boolean", "kept": "boolean", "base_score": "double", "target": "double",
    "predicted": "int", "piece": "int", "shard": "int", "grown_shard": "int",
}
STRINGS = {"fingerprint", "law", "text_sha256", "payload_digest", "record_type", "lang_pred", "lang", "phrase", "runs_sha256", "collapsed_sha256"}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, BASE, "documents").collect()}


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def rows(name):
        if name not in kept:
            frame = QUERIES[name](spark, BASE)
            kept[name] = (dict(frame.dtypes), frame.collect())
        return kept[name]

    return rows


@pytest.mark.parametrize("name", QUERIES)
def test_names_types_and_rows(result, texts, name):
    types, rows = result(name)
    wanted = COLUMNS[name].split()
    assert set(wanted) <= set(types)
    for column in wanted:
        score = "bigint" if name == "op11_collocations" else "double"
        kind = "string" if column in STRINGS else score if column == "score" else OTHERS.get(column, "bigint")
        assert types[column] == kind, column
    if "doc_id" in wanted and name != "op4_best_fit_packing":
        assert sorted(r.doc_id for r in rows) == sorted(texts)


@pytest.mark.parametrize("name, modulus, rest", [
    ("op2_lm_scoring", 7, 2), ("op3_toxicity", 3, 1), ("op10_language_id", 4, 2), ("op12_quality_classifier", 5, 0),
])
def test_remainders_and_scores(result, name, modulus, rest):
    for r in result(name)[1]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert math.isfinite(r.score) and (r.score < 0 if name == "op2_lm_scoring" else 0 <= r.score <= 1)
        if "predicted" in r:
            assert r.predicted == (r.score >= (0.7 if name == "op3_toxicity" else 0.3))


def test_op1_base(result, texts):
    for r in result("op1_quality_rules")[1]:
        plain = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain
        assert r.base_failed == (plain[0] < 20 or 100 * plain[4] > 30 * plain[0])
        assert not (r.base_failed and r.kept)


def test_op2_base(result, texts):
    words = {k: [*(t.encode().lower().split()), b""] for k, t in texts.items()}
    learned = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = collections.Counter(w for k in learned for w in words[k])
    total = sum(counts.values())
    for r in result("op2_lm_scoring")[1]:
        own = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), total)
        plain = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert r.base_score == pytest.approx(plain, rel=1e-9)


def plain_components(prints):
    """Smallest key that is reachable over links of at most three bits."""
    keys = sorted(prints)
    found = {}
    for key in keys:
        if key in found:
            continue
        open_ = [key]
        found[key] = key
        while open_:
            own = prints[open_.pop()]
            for other in keys:
                if other not in found and (own ^ prints[other]).bit_count() <= 3:
                    found[other] = key
                    open_.append(other)
    return found


def plain_print(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_op5(result, texts):
    prints = {k: plain_print(t) for k, t in texts.items()}
    components = plain_components(prints)
    for r in result("op5_simhash")[1]:
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", components[r.doc_id])


def packed_wholly(rows, texts, copies=None):
    """Pieces rebuilt from the texts, and sequences without gaps."""
    coder = WordEncoder(vocabulary_path("word_bpe_49k.json"))
    expected = collections.Counter()
    for key, text in texts:
        ids = np.append(coder.encode(text), 0).astype("<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            cut = ids[start : start + 2048]
            expected[key, piece, start, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    at = collections.Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 2048
    return len(at), sum(at.values())


def test_op4(result, texts):
    bins, ids = packed_wholly(result("op4_best_fit_packing")[1], texts.items())
    assert bins <= 1.02 * math.ceil(ids / 2048) + 1


def test_op7(result, texts):
    rows = result("op7_shard_documents")[1]
    places, sizes = collections.defaultdict(list), collections.Counter()
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        places[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(places) <= set(range(40)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    mean = sum(sizes.values()) / 40
    assert max(sizes.values()) <= mean + max(len(t.encode()) + 16 for t in texts.values())


def test_op9(spark, result):
    pages = {r.page_id: (r.html or "").encode() for r in table(spark, BASE, "pages").collect()}
    holder = {}
    for page, payload in sorted(pages.items()):
        holder[payload] = page
    rows = result("op9_warc_archive")[1]
    assert len(rows) == len(pages)
    for r in rows:
        payload = pages[r.page_id]
        first = holder[payload]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = ("response", None) if first == r.page_id else ("revisit", first)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(payload), digest, *kind)


def test_op13(result, texts):
    planted = 0
    for r in result("op13_periodic_runs")[1]:
        crc = zlib.crc32(str(r.doc_id).encode())
        words = runs.repeat_tail(texts[r.doc_id].encode().split(), crc)
        if len(words) > 1200:
            continue
        plain = by_start(plain_runs(words))
        planted += bool(crc % 10 == 0 and plain)
        best = min(plain, key=lambda x: (-x[1], x[0], x[2])) if plain else (None, None, None)
        milli = 1000 * best[1] // best[2] if plain else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(plain), *best, milli)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in plain)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        dropped = {i for a, b, c in plain for i in range(a + c, a + b)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert planted > 3


def test_the_pipeline_stage_by_stage(spark):
    """Each stage against brute force on what the stage before it kept."""
    docs = table(spark, LARGER, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, LARGER)
    kept.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/stage-1")
    kept = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/stage-1")
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()

    best = {}
    for r in kept.collect():
        best[r.text or ""] = max(best.get(r.text or "", r), r, key=lambda r: r.doc_id)
    unique = stages["exact dedup"](spark, kept, LARGER).cache()
    assert sorted(unique.collect()) == sorted(best.values())

    prints = {r.doc_id: plain_print(r.text or "") for r in unique.collect()}
    components = plain_components(prints)
    apart = stages["SimHash near-dedup"](spark, unique, LARGER).cache()
    assert sorted(r.doc_id for r in apart.collect()) == sorted(set(components.values()))
    assert apart.columns == docs.columns

    mixed = stages["mixing sources to target weights"](spark, apart, LARGER).cache()
    assert mixed.columns == docs.columns
    whole = {r.doc_id: (r.source, (r.text or "").encode().split()) for r in apart.collect()}
    size, taken = collections.Counter(), collections.Counter()
    for source, words in whole.values():
        size[source] += len(words)
    for r in mixed.collect():
        words = (r.text or "").encode().split()
        assert words == whole[r.doc_id][1][: len(words)]  # whole, or cut at the budget
        taken[r.source] += len(words)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.01)
    assert all(taken[s] <= 2 * size[s] for s in size)

    packed_wholly(
        stages["best-fit packing"](spark, mixed, LARGER).collect(), [(r.doc_id, r.text) for r in mixed.collect()]
    )


def test_the_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, LARGER)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 100


