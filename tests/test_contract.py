"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from runweave.plans.table_queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = ordered(tuple(r[c] for c in columns) for r in result.collect())
    answer = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = ordered(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["f12_run_summary", "f13_sample_events"])
def test_line_items_are_dealt_once(spark, name):
    """The spread of the line items is by the key of their join with the orders, which needs no shuffle of its own."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert dealt and not [line for line in dealt if "ENSURE_REQUIREMENTS" in line]


def test_events_of_clade_files_come_from_one_parse(spark):
    """Everything that the events need of the clade files reads one shuffle, so the line items are joined and parsed once for it."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plan = QUERIES["f13_sample_events"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    parses = [line for line in plan.splitlines() if re.search(r"array_position\(header#\d+, alignmentScore\)", line)]
    assert len(parses) == 1
