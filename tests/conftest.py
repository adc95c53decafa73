import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomset.session import build_session  # noqa: E402
from loomset.sources.reader import EXAMPLE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def examples(spark):
    """Build instruction rows from tuples (instruction, context, response, output)."""

    def build(*rows, keyed=True):
        frame = spark.createDataFrame([r + (None,) * (4 - len(r)) for r in rows], EXAMPLE_SCHEMA)
        if not keyed:
            return frame
        numbered = [(i, *r, *(None,) * (4 - len(r))) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            numbered,
            "example_id long, instruction string, context string, response string, output string",
        )

    return build


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
