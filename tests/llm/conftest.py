from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame from rows and a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
