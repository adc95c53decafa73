"""Batch inference: a prompt column in, a prediction column out. The model is the caller's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomset.functions.text import or_empty, strip
from loomset.functions.tokens import first_tokens, without_markers
from loomset.operators.identity import KEY

# Fixed value: prompts are cut to this many tokens before generation.
PROMPT_TOKENS = 2048

Generator = Callable[[list[str]], list[str]]


def clean_prediction(output: Column, prompt: Column, max_new_tokens: int) -> Column:
    """What a model wrote after the prompt: at most so many tokens, no markers, stripped."""
    new = F.when(
        F.startswith(output, prompt), F.substr(output, F.length(prompt) + F.lit(1))
    ).otherwise(output)
    return strip(without_markers(first_tokens(new, max_new_tokens)))


def batch_predict(
    prompts: DataFrame,
    make_generator: Callable[[], Generator],
    model: str,
    max_new_tokens: int = 128,
    max_prompt_tokens: int = PROMPT_TOKENS,
    partitions: int | None = None,
) -> DataFrame:
    """Predictions ``(example_id, model, prediction)`` for a table with key and ``prompt``.

    ``make_generator`` runs once per partition in the Python worker and returns a function from
    a batch of prompts to the full outputs, each the prompt and its continuation (an output
    that does not begin with the prompt counts as continuation). Batches have
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows. ``partitions`` spreads prompts over
    that many tasks when the scan's own split is too coarse for slow generation. Store the
    result before using it twice.
    """
    fed = prompts.select(
        KEY, first_tokens(or_empty(F.col("prompt")), max_prompt_tokens).alias("prompt")
    )
    if partitions is not None:
        fed = fed.repartition(partitions, KEY)

    def generate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = None
        for batch in batches:
            generator = generator or make_generator()
            outputs = generator(batch["prompt"].tolist())
            if len(outputs) != len(batch):
                raise ValueError(f"generator gave {len(outputs)} outputs for {len(batch)} prompts")
            yield batch.assign(output=outputs)

    schema = StructType([*fed.schema.fields, StructField("output", StringType())])
    prediction = clean_prediction(or_empty(F.col("output")), F.col("prompt"), max_new_tokens)
    return fed.mapInPandas(generate, schema).select(
        KEY, F.lit(model).alias("model"), prediction.alias("prediction")
    )
