"""A corpus pipeline: each stage calls one operator of ``loomset.llm``.

Stages pass the columns of ``documents`` on, extra ones included; the last returns pieces and where
they are packed. A row stands for itself: rows with equal ``doc_id`` are decided on one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import exact_dedup, mixing, packing, simhash, toxicity
from loomset.llm.common import fold, stored, table

#: The stages hash, score and tokenize whole texts in ways that SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; learned from the corpus's labels."""
    corpus = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = toxicity.labelled_rows(corpus, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, toxicity.fit(known), docs.columns)
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select("__row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest ``doc_id``."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: its smallest ``doc_id``."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's budget is cut there."""
    return mixing.materialise(mixing.mix(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 2,048 tokens."""
    pieces = stored(packing.tokenize_pieces(docs.select("doc_id", "text"), with_ids=False).drop("ids"), "pieces")
    return packing.pack(pieces).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
