from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def docs(spark):
    import fixtures

    rows = fixtures.documents()
    return rows, spark.createDataFrame(rows, fixtures.SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    import fixtures

    return spark.createDataFrame([], fixtures.SCHEMA)
