"""The queries of this package against SQL, and the pipeline stage by stage."""

from __future__ import annotations

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import queries

ORACLES = queries.oracle_sql()


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert not set(ORACLES) - set(queries.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, data_folder, name):
    df = queries.queries()[name](spark, data_folder)
    cursor = connect(data_folder).execute(ORACLES[name])
    found = difference([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(), [c[0] for c in cursor.description])
    assert found is None, found


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(ORACLES)))
def test_other_queries_run(spark, data_folder, name):
    assert queries.queries()[name](spark, data_folder).count() > 0


def test_pipeline(spark, data_folder):
    docs = queries.table(spark, data_folder, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, data_folder), name)
        assert docs.columns == columns
        after = docs.count()
        assert 0.5 * before <= after <= before
        before = after
    assert docs.where(F.col("text").rlike("[a-z0-9]@[a-z0-9]+[.][a-z]")).isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data_folder)
    assert last.count() == before and "ids" in last.columns


def test_pipeline_on_odd_rows(spark, tmp_path, data_folder):
    rows = [(None, None, None), (1, "", None), (2, "x", 5), (2, "x", 5), (3, "a b c d e f", None), (4, "a b c d e f", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = odd
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, got, data_folder)
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0, 1, 2, 2, 3]
    empty = odd.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, data_folder)
    assert empty.count() == 0
