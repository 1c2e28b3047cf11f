"""Every registered query against its SQL, and the shape of its plan."""
import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom import catalog
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
CATALOG = catalog.QUERIES  # the text operators have tests of their own


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, con, plan, name):
    df = QUERIES[name](spark, FOLDER)
    physical = plan(df)
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert "EvalPython" not in physical and "InPandas" not in physical and "InArrow" not in physical
    ok, note = compare(spark, con, FOLDER, name, lambda *_: df, ORACLES.get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(CATALOG) <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    out = entry.entry(spark)
    assert {"agent_id", "final_limit", "is_qualified"} <= set(out.columns) and out.count() > 0


def test_rank_filters_are_cut_before_the_shuffle(spark, plan):
    for name in ("latest_loan", "top3_per_key", "tenure_rules"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, FOLDER)), name


def test_filters_and_columns_reach_the_scan(spark, plan):
    physical = plan(QUERIES["hourly_rollup"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts," in physical and "ReadSchema: struct<ts:timestamp_ntz,value:double>" in physical
