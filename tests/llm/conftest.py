import sys

import pytest
from llm_helpers import ODD, ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(autouse=True)
def _workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with extra columns whose names clash with internal ones."""
    rows = [(i, t, "doc", 1, 2, "kept", 3.0, 4) for i, t in ODD]
    schema = "doc_id long, text string, doc string, chunk int, n int, kept string, score double, length int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, doc string")
