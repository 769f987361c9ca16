"""Registered batch queries against their SQL text on the smallest tables.

By default the families below run; ALL_QUERIES=1 runs every batch query (about ten minutes).
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Streams take seconds each; tools/compare.py runs them, tests/test_streaming.py covers the jobs.
FAMILIES = ("report_", "freight_report_", "product_report_", "fn_", "clean_", "join_", "quality_", "table_")
BATCH = [name for name in QUERIES if not name.startswith("stream_") and name in ORACLES
         and (os.environ.get("ALL_QUERIES") or name.startswith(FAMILIES))]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["stream_dirty_logs", "stream_interval_join_5min", "stream_dimension_sync", "stream_newer_only", "stream_repair_is_new"])
def test_stream_equals_sql(spark, con, name):
    test_query_equals_sql(spark, con, name)


def test_flagship(spark):
    assert entry.entry(spark).columns[0] in ("tm_id", "dt", "recent_days")


def test_registered_queries_have_sql():
    from tidemart.registry.base import ORACLES as own_sql, QUERIES as own
    assert set(own) == set(own_sql)
