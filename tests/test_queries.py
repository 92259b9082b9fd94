"""Every registered query against its DuckDB oracle on the sf0.001 tables, the
driver contract, and the shape of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

ORACLE = sorted(entry.oracle_sql())
ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, SF_SMALL)
    assert result["status"] == "match", result


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["customer_count"] == 150
    assert df.schema == entry.entry(spark).schema


def test_every_query_has_a_name_and_columns(spark):
    assert len(entry.queries()) >= 56
    for name in entry.oracle_sql():
        assert name in entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_pushes_filter_to_scan(spark):
    from churnlab.sources import roles

    c = roles.customers(spark, SF_SMALL).filter(F.col("customer_id") == 42)
    plan = _plan(c)
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,42)]" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(entry.queries()["customer_360"](spark, SF_SMALL))
    lineitem_scan = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert lineitem_scan and "l_extendedprice" not in lineitem_scan[0]


def test_kpi_drops_unused_summaries(spark):
    plan = _plan(entry.queries()["kpi_summary"](spark, SF_SMALL))
    assert "lineitem" not in plan  # usage summary is never read by the KPI row


def test_rank_is_spread_over_partitions(spark):
    from churnlab.operators import ranking

    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    ranked = ranking.global_rank(df, [F.col("s").asc(), F.col("k").asc()], "r", "n")
    assert ranked.rdd.getNumPartitions() > 1
    per_part = ranked.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(per_part) < 5000
