"""Every query with SQL equals it on the smallest tables; plans stay as designed."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from shoptide.plans import registry
from tests.conftest import SF_DIR

# The corpus queries, if they are there, have tests of their own.
QUERIES, SQL = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == want
    plan = plan_of(got)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "PythonRDD"):
        assert operator not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("q_dau_hours", ["EqualTo(event_type,view)", "GreaterThanOrEqual(ts,", "LessThan(ts,"], "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("q_gmv_hours", ["GreaterThanOrEqual(o_orderdate,", "LessThan(o_orderdate,"], "o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"),
        ("q_dau_mark_seen", ["EqualTo(event_type,view)"], "ts:timestamp_ntz,user_id:bigint,event_type:string"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100")
    df = QUERIES[name](spark, SF_DIR)
    text = spark._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed_filters = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert all(f in pushed_filters for f in pushed)
    assert f"ReadSchema: struct<{columns}>" in text


@pytest.mark.parametrize("name", ["q_dau_total", "q_dau_daily"])
def test_totals_shuffle_only_what_they_count(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and "Window" not in plan and "uid" not in plan


def test_the_index_is_searched_by_its_day_in_one_folder(spark):
    """A scan for the figures and one for the page, of the day alone."""
    plan = plan_of(QUERIES["q_sale_report_index"](spark, SF_DIR))
    scans = plan.split("FileScan")[1:]
    assert len(scans) == 2
    for scan in scans:
        assert "2024-01" in scan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(dt,2024-01-15)" in scan


def test_entry(spark):
    assert entry.entry(spark).columns == ["log_hour", "ct"]
