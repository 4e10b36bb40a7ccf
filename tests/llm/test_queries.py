"""Registered queries against their SQL, and the pipeline stage by stage, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from runweave.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def ordered(rows):
    return sorted(rows, key=str)


def test_all_are_registered():
    names = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = ordered(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
    assert ordered(tuple(r[c] for c in columns) for r in result.collect()) == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = {row.doc_id: row.text for row in docs.collect()}
    ids = set(seen)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR).cache()
        now = {row.doc_id for row in out.collect()}
        assert now <= ids and now, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert out.count() == len(now)
            ids = now
        docs = out
    assert now == ids  # packing keeps every document
    copies = {}
    for i in sorted(ids):
        copies.setdefault(seen[i], []).append(i)
    assert max(map(len, copies.values())) == 1


def test_pipeline_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).selectExpr("*", "1 as kept", "'x' as topic", "2 as component")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() > 0, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
