"""Every registered query against its SQL oracle, and the invariants of the registry."""

from __future__ import annotations

import pytest
from compare import connect, difference

from workload import oracles, queries

QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(data_folder):
    return connect(data_folder)


def test_only_the_forest_has_no_oracle():
    assert set(QUERIES) - set(ORACLES) == {"isolation_forest", "isolation_top"}
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, data_folder, name):
    df = QUERIES[name](spark, data_folder)
    cursor = duck.execute(ORACLES[name])
    found = difference([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(), [c[0] for c in cursor.description])
    assert found is None, found


def test_forest_queries_run(spark, data_folder):
    summary = QUERIES["isolation_forest"](spark, data_folder).collect()
    assert len(summary) == 1 and summary[0]["rows_analyzed"] == 6376
    assert len(QUERIES["isolation_top"](spark, data_folder).collect()) == 20


def test_fixture_counts(spark, data_folder):
    """Counts worked out for the smallest scale; the oracle shares none of this arithmetic."""
    from workload.fixture import Tables

    t = Tables(spark, data_folder)
    assert t.dirty_orders().count() == 6376
    assert t.clean_orders().count() == 6000
    row = QUERIES["uniqueness_exact"](spark, data_folder).first()
    assert row["duplicate_rows"] == 377
    assert QUERIES["uniqueness_key"](spark, data_folder).first()["duplicate_keys"] == 1777
    assert QUERIES["consistency_referential"](spark, data_folder).first()["orphan_records"] == 213
    assert QUERIES["consistency_arithmetic"](spark, data_folder).first()["inconsistent_rows"] == 54
    assert QUERIES["validity_future_dates"](spark, data_folder).first()["future_dates"] == 55
