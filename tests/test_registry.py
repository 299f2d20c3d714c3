"""Every registered query against its SQL oracle (DuckDB) on sf0.001, and
plan checks on the physical plans."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from reckon.plans.oracle import ORACLE  # noqa: E402
from reckon.plans.registry import QUERIES  # noqa: E402
from helpers import plan_text  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderpriority", "o_orderstatus", "month", "prev_value", "curr_value", "percent_diff", "over_hi", "under_lo"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(rel.columns, orows)


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    df = QUERIES[name](spark, SF)
    plan = plan_text(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_scan_filter_pushdown(spark):
    plan = plan_text(QUERIES["scan_filter"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in plan


def test_projection_pruned_at_scan(spark):
    plan = plan_text(QUERIES["lookup_left"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_with_shuffle_joins(no_broadcast, duck, name):
    """Same results on the join strategy large sides get at scale."""
    df = QUERIES[name](no_broadcast, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    assert digest(df.columns, srows) == digest(rel.columns, rel.fetchall())


# Single-source queries that must read their table exactly once.
ONE_SCAN = ["scan_filter", "like_not_like", "project_swap", "blank_filter", "contains_literal", "distinct_multi", "snapshot_prev_month",
            "agg_sum_by_month", "group_amount_match", "any_match_group", "priority_rollup", "first_per_group_nulls_first", "dedupe_latest",
            "sort_multi", "str_funcs", "date_funcs", "safe_cast", "scale_amount", "period_compare_yyyymm", "case_rules", "cycle_date_fix",
            "staged_status", "typed_id_pivot", "first_per_group_mixed", "waterfall_keep_existing", "period_compare"]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_single_source_read_once(spark, name):
    import re

    txt = plan_text(QUERIES[name](spark, SF))
    scans = set(re.findall(r"^\((\d+)\) Scan parquet", txt, flags=re.M))
    assert len(scans) == 1, f"{name}: {len(scans)} scans"
