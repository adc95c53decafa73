"""Instruction-dataset preparation and scoring as Spark jobs."""

import sys

from pyspark import cloudpickle

from loomset.params import DatasetParams, EvaluationParams, JobParams
from loomset.plans.evaluate import evaluate
from loomset.plans.explore import explore
from loomset.plans.prepare import prepare, prepare_rows
from loomset.plans.training import training_text

__all__ = [
    "DatasetParams",
    "EvaluationParams",
    "JobParams",
    "evaluate",
    "explore",
    "prepare",
    "prepare_rows",
    "training_text",
]

# The few Python helpers travel with their tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
