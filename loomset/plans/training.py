"""Training-text job: what a trainer reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomset.operators.gates import require_splits
from loomset.params import DatasetParams
from loomset.sources.reader import load_splits


def training_text(spark: SparkSession, params: DatasetParams) -> dict[str, DataFrame]:
    """The text column of the train and the validation split; both must hold rows.

    The two splits differ only in the partition filter, so each read touches its own files.
    """
    splits = load_splits(spark, params.processed_dir)
    texts = {
        name: splits.where(splits["split"] == name).select(params.text_field)
        for name in ("train", "validation")
    }
    # One row answers the question; only the error message needs the counts.
    if any(text.isEmpty() for text in texts.values()):
        require_splits({name: text.count() for name, text in texts.items()}, tuple(texts))
    return texts
