"""Language-model scores of whole texts, beside an add-one word model.

Word counts are taken over all training texts by a distributed aggregate. From them come the word
model, and, by encoding each distinct word once, the counts of subwords and of subword pairs inside
words. A causal self-attention model (``attention``) learns on subword ids from all training texts: in
each round every task trains on its texts, and the weights are averaged over all tasks in proportion
to the positions they saw.

The model predicts a class per position; which id of the class it is follows from the id before, by
counts. Classes hold ids that stand in like surroundings. Ids beyond the ``KEPT`` most frequent ones
count as one and are told apart by their add-one share of it. So the probabilities of all ids sum
to one. A text's score counts each of its ids and its end once.

Texts are encoded once, in the order they lie in; learning and scoring read the kept ids of each.

The frequent words, at most ``HEAVY`` since each makes up at least that share of all words, are
looked up in the task that reads a text; rarer ones meet their counts in a join, where no word of
the training texts is frequent any more.

Defined results: a null text is empty and still has its end; words unknown to training count 0; without
training texts counts are empty and the model knows uniform priors only; repeated rows are scored
each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm import attention
from loomset.llm.common import split_words, stored
from loomset.llm.subwords import encoder, vocabulary_path

#: A word is heavy if it makes up at least one in so many training tokens.
HEAVY = 1 << 17
#: Ids that the model tells apart by context, the text's end and the shared one included; classes.
KEPT = 2048
CLASSES = 96
#: Dimensions that describe an id's neighbours for the classes.
SKETCH = 24
#: Weight of an id's plain frequency beside the counts after another id.
SMOOTH = 10.0
#: Rounds over all training texts.
ROUNDS = 1
#: Words that a counting task holds before it passes them on.
HELD_WORDS = 150_000
#: Words whose ids a worker process remembers, beside the model and the counts it holds.
CACHED_WORDS = 200_000
#: Positions scored at once.
POSITIONS = 1 << 17
#: Stands for a text's end among words, which cannot be empty; and among subword ids.
END_WORD = b""


@dataclass
class Subwords:
    """How ids map to kept ones: what every task needs, and no more."""

    kept: np.ndarray  # (vocabulary + 1,): number of an id among the kept ones
    other: np.ndarray  # (vocabulary + 1,): log share of an id among those that count as one


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts[END_WORD] += 1
            if text.is_valid:
                counts.update(text.as_buffer().to_pybytes().lower().split())
            if len(counts) > HELD_WORDS:
                yield out()
                counts.clear()
    if counts:
        yield out()


def count_words(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over whole lower-cased texts; the end of a text counts as the empty word."""
    return texts.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _subword_pairs(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Counts of (previous id, id) inside words; -1 stands before a word's first id."""
    coder = encoder(path, CACHED_WORDS)
    end = coder.tokenizer.get_vocab_size()
    for batch in batches:
        words = batch.column("word").to_pylist()
        n = batch.column("n").to_numpy()
        text = [i for i, w in enumerate(words) if w]
        ids, sizes = coder.encode_words([words[i] for i in text])
        ids = ids.astype(np.int64)
        weight = np.repeat(n[text], sizes)
        before = np.concatenate([[-1], ids[:-1]]) if len(ids) else ids
        begins = (np.cumsum(sizes) - sizes)[sizes > 0]
        before[begins] = -1
        finals = n[[i for i, w in enumerate(words) if not w]]
        pairs = np.concatenate([(before + 1) * (end + 2) + ids, np.full(len(finals), end)])
        keys, at = np.unique(pairs, return_inverse=True)
        total = np.bincount(at, np.concatenate([weight, finals]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys // (end + 2) - 1), pa.array(keys % (end + 2)), pa.array(total)], names=["before", "id", "n"]
        )


def learn_subwords(words: DataFrame, path: str) -> tuple[Subwords, np.ndarray, np.ndarray]:
    """Kept ids, their counts, and log probabilities after another id or at a text's start.

    What follows a word does not depend on it here: what starts words, or ends the text, does so in
    proportion to its count. The driver gets a count per id and one per pair of kept ids.
    """
    pairs = stored(words.mapInArrow(lambda b: _subword_pairs(b, path), "before long, id long, n long"), "subword-pairs")
    size = encoder(path, CACHED_WORDS).tokenizer.get_vocab_size() + 1  # with the end of a text
    counts = np.zeros(size, np.int64)
    single = pairs.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts[single["id"].to_numpy()] = single["n"].to_numpy()
    own = [i for i in np.lexsort((np.arange(size), -counts)).tolist() if i != size - 1][: KEPT - 2]
    kept = np.full(size, KEPT - 1, np.int64)
    kept[own] = np.arange(len(own))
    kept[size - 1] = KEPT - 2
    rest = kept == KEPT - 1
    other = np.zeros(size)
    other[rest] = np.log((counts[rest] + 1) / (counts[rest].sum() + rest.sum()))
    numbers = words.sparkSession.createDataFrame([(i, int(k)) for i, k in enumerate(kept)], "id long, k int")
    numbers = F.broadcast(numbers)  # a row per id of the vocabulary
    known = pairs.join(numbers.withColumnRenamed("k", "b"), "id").join(
        numbers.select(F.col("id").alias("before"), F.col("k").alias("a")), "before", "left"
    )
    summed = known.groupBy(F.coalesce("a", F.lit(KEPT)).alias("a"), "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((KEPT + 1, KEPT))
    table[summed["a"].to_numpy(), summed["b"].to_numpy()] = summed["n"].to_numpy()
    total = np.bincount(kept, counts, KEPT)
    plain = (total + 0.1) / (total + 0.1).sum()
    start = (table[KEPT] + 0.1 * plain) / (table[KEPT].sum() + 0.1)
    # An id ends a word as often as nothing follows it inside one.
    ending = np.maximum(0, total - table[:KEPT].sum(1))
    ending[KEPT - 2] = 0
    mixed = table[:KEPT] + ending[:, None] * start + SMOOTH * plain
    mixed /= mixed.sum(1, keepdims=True)
    return Subwords(kept, other), total, np.log(np.vstack([mixed, start]))


def _sketched(batches: Iterator[pa.RecordBatch], codes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the codes of each kept id's neighbours on either side, across words."""
    pairs = np.zeros(KEPT * KEPT)
    for batch in batches:
        for ids, sizes in _portions(batch):
            places = ids[:-1].astype(np.int64) * KEPT + ids[1:]
            inside = np.ones(len(places), bool)
            inside[np.cumsum(sizes)[:-1] - 1] = False
            np.add.at(pairs, places[inside], 1.0)
    pairs = pairs.reshape(KEPT, KEPT)
    flat = np.hstack([pairs @ codes, pairs.T @ codes]).ravel()
    used = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["place", "weight"])


def learn_classes(encoded: DataFrame, counts: np.ndarray) -> np.ndarray:
    """Class of each kept id: k-means over random sketches of its neighbours; the end has its own.

    The driver gets a fixed number of sums.
    """
    codes = np.random.default_rng(2).normal(0, 1, (KEPT, SKETCH))
    found = encoded.select("ids", "text_bytes").mapInArrow(lambda b: _sketched(b, codes), "place long, weight double")
    rows = found.groupBy("place").agg(F.sum("weight").alias("weight")).toArrow()
    sums = np.zeros(KEPT * 2 * SKETCH)
    sums[rows["place"].to_numpy()] = rows["weight"].to_numpy()
    points = sums.reshape(KEPT, -1) / (counts[:, None] + 20.0)
    centres = points[np.argsort(-counts, kind="stable")[: CLASSES - 1]]
    for _ in range(15):
        apart = (centres**2).sum(1) - 2 * points @ centres.T
        near = apart.argmin(1)
        weight = np.bincount(near, counts + 1, CLASSES - 1)
        for k in range(points.shape[1]):
            new = np.bincount(near, points[:, k] * (counts + 1), CLASSES - 1)
            centres[:, k] = np.where(weight > 0, new / np.maximum(weight, 1e-9), centres[:, k])
    near[KEPT - 2] = CLASSES - 1
    return near


def _cuts(text_bytes: list[int]) -> Iterator[slice]:
    """Rows in portions of some ``POSITIONS`` ids, by the lengths of their texts."""
    start, held = 0, 0
    for i, size in enumerate(text_bytes):
        held += 1 + size // 2
        if held > POSITIONS:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(text_bytes):
        yield slice(start, len(text_bytes))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kept ids of encoded texts, one after the other, and the texts' sizes, portion by portion."""
    coded = [ids.as_buffer() for ids in batch.column("ids")]
    for rows in _cuts(batch.column("text_bytes").to_pylist()):
        sizes = np.array([ids.size // 2 for ids in coded[rows]])
        yield np.frombuffer(b"".join(coded[rows]), "<u2").astype(np.int64), sizes


def _kept_ids(texts: list[list[bytes]], path: str, subwords: Subwords) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept numbers and shares of all ids of texts' lower-cased words, ends included, and texts' sizes."""
    coded = encoder(path, CACHED_WORDS).coded(texts)
    end = np.array([len(subwords.kept) - 1], "<u4").tobytes()
    flat = np.frombuffer(end.join([*coded, b""]), "<u4")
    return subwords.kept[flat], subwords.other[flat], np.array([len(ids) // 4 + 1 for ids in coded], np.int64)


def _train_part(batches: Iterator[pa.RecordBatch], model: attention.AttentionModel) -> Iterator[pa.RecordBatch]:
    """One task's round: train on its texts portion by portion; weights times positions seen."""
    own, seen = model.with_flat(model.flat()), 0
    for batch in batches:
        for ids, sizes in _portions(batch):
            attention.train(own, ids, sizes)
            seen += int(sizes.sum())
    if seen:
        weights = own.flat().astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(weights))), pa.array(weights * seen), pa.array(np.full(len(weights), seen))],
            names=["place", "weight", "seen"],
        )


def fit(encoded: DataFrame, counts: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, attention.AttentionModel]:
    """Classes and attention from the kept ids of all training texts (ids, text_bytes)."""
    kind = learn_classes(encoded, counts)
    chances = np.zeros((KEPT + 1, CLASSES))
    for k in range(CLASSES):
        chances[:, k] = np.exp(follow[:, kind == k]).sum(1)
    prior = np.log(np.maximum(chances, 1e-12))
    within = (follow - prior[:, kind]).astype(np.float32)
    model = attention.AttentionModel.fresh(prior, np.append(kind, CLASSES))
    for _ in range(ROUNDS):
        now = model
        trained = encoded.select("ids", "text_bytes").mapInArrow(
            lambda b: _train_part(b, now), "place long, weight double, seen long"
        )
        averaged = trained.groupBy("place").agg((F.sum("weight") / F.sum("seen")).alias("weight")).toArrow()
        flat = model.flat()
        flat[averaged["place"].to_numpy()] = averaged["weight"].to_numpy()
        model = model.with_flat(flat)
    return within, model


_CODED = (
    "row long, n_tokens long, heavy_known long, heavy_sum double, other double, ids binary, text_bytes long, "
    "words array<struct<word:binary,n:long>>"
)
_CODED_ARROW = pa.schema(
    [
        ("row", pa.int64()), ("n_tokens", pa.int64()), ("heavy_known", pa.int64()), ("heavy_sum", pa.float64()),
        ("other", pa.float64()), ("ids", pa.binary()), ("text_bytes", pa.int64()),
        ("words", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ]
)


def _encode_rows(batches: Iterator[pa.RecordBatch], path: str, subwords: Subwords, heavy: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Kept ids and the shares of others, the heavy words' part of the word model, and all other words with counts."""
    log10 = {word: float(np.log10(n + 1)) for word, n in heavy.items()}
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        whole = batch.column("__text")
        lengths = [t.as_buffer().size if t.is_valid else 0 for t in whole]
        for part in _cuts(lengths):
            texts = [(t.as_buffer().to_pybytes() if t.is_valid else b"").lower().split() for t in whole[part]]
            ids, other, sizes = _kept_ids(texts, path, subwords)
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0.0], np.cumsum(other)])
            raw = ids.astype("<u2").tobytes()
            coded = [raw[2 * (end - size) : 2 * end] for end, size in zip(ends.tolist(), sizes.tolist())]
            n_tokens, known, total, rare, times, after = [], [], [], [], [], [0]
            for words in texts:
                counts = Counter(words)
                counts[END_WORD] = 1
                own, logs = 0, 0.0
                for word in [word for word in counts if word in log10]:
                    n = counts.pop(word)
                    own += n
                    logs += n * log10[word]
                n_tokens.append(len(words) + 1)
                known.append(own)
                total.append(logs)
                rare.extend(counts.keys())
                times.extend(counts.values())
                after.append(len(rare))
            fields = [pa.array(rare, pa.binary()), pa.array(times, pa.int64())]
            rest = pa.ListArray.from_arrays(pa.array(after, pa.int32()), pa.StructArray.from_arrays(fields, ["word", "n"]))
            rows = np.arange(row, row + len(texts))
            row += len(texts)
            values = (rows, n_tokens, known, total, sums[ends] - sums[ends - sizes], coded, lengths[part])
            cut = batch.slice(part.start, len(texts))
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(cut.column(n) for n in names), *(pa.array(v, f.type) for v, f in zip(values, _CODED_ARROW)), rest],
                names=[*names, *_CODED_ARROW.names],
            )


def _score_rows(batches: Iterator[pa.RecordBatch], within: np.ndarray, model: attention.AttentionModel) -> Iterator[pa.RecordBatch]:
    """Attention scores of encoded texts."""
    for batch in batches:
        scores = [attention.score(model, within, ids, sizes) for ids, sizes in _portions(batch)]
        total = np.concatenate([*scores, np.zeros(0)]) + batch.column("other").to_numpy()
        names = [n for n in batch.schema.names if n not in ("ids", "text_bytes", "other")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(total / np.log(10), pa.float64())], names=[*names, "score"]
        )


def score_texts(docs: DataFrame, columns: list[str], learn: str, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``columns`` of every document, token counts, word-model score and attention score.

    ``learn`` is the SQL condition of the rows that may be learned from.
    """
    path = vocabulary or vocabulary_path("word_bpe_49k.json")
    texts = docs.where(learn).select(F.col(text).cast("string").alias("text"))
    words = stored(count_words(texts), "word-counts")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    heavy = {bytes(r["word"]): r["n"] for r in words.where(F.col("n") * HEAVY >= n).collect()}
    subwords, counts, follow = learn_subwords(words, path)
    rows = docs.select(*columns, F.expr(learn).alias("__learn"), F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
    encoded = stored(rows.mapInArrow(lambda b: _encode_rows(b, path, subwords, heavy), f"{schema}, {_CODED}"), "lm-ids")
    within, model = fit(encoded.where("__learn"), counts, follow)
    narrow = encoded.drop("__learn", "words")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.drop("ids", "text_bytes", "other").schema)
    scored = stored(narrow.mapInArrow(lambda b: _score_rows(b, within, model), f"{schema}, score double"), "lm-scores")
    light = words.where(F.col("n") * HEAVY < n).select("word", F.col("n").alias("c"))
    rest = encoded.select("row", F.inline("words"))
    found = (
        rest.join(light, "word").groupBy("row")
        .agg(F.sum("n").alias("light_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("light_sum"))
    )
    known = F.col("heavy_known") + F.coalesce("light_known", F.lit(0))
    logs = F.col("heavy_sum") + F.coalesce("light_sum", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        *columns,
        "n_tokens",
        known.alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        "score",
    )
