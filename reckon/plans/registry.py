"""Registry of the operator queries on the driver tables.

Roles: detail = ``lineitem``, header = ``orders``, dimensions = ``part``,
``customer``, ``supplier``, ``nation``, ``region``; attribute facts =
``events``. Every query reads whole tables; each has an independent SQL
twin in ``reckon.plans.oracle`` with the same column names.

Money sums are exact (``decimal(18,2)``) and cast to double at the edge.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reckon.functions.columns import (
    blank_to_null,
    ci_like,
    ci_ne,
    ci_not_like,
    ci_where,
    clamped_diff,
    concat_strict,
    contains_lit,
    drop_ci,
    is_blank,
    key_concat,
    money,
    ne_null_safe,
    safe_date,
    safe_num,
    scale_by_decimals,
    with_ci,
)
from reckon.functions.dates import (
    check_date,
    cycle_date,
    mdy,
    period_month,
    period_year,
    prev_month_abbr,
    ts_literal,
    yyyymm,
)
from reckon.operators.compare import compare_periods, latest_snapshot, period_compare, sum_by_month
from reckon.operators.lookup import anti_not_in, lookup, propagate_by_key, semi_in
from reckon.operators.pivot import fan_out_typed_ids, pivot_attributes, pivot_typed_ids, role_dims
from reckon.operators.rollup import (
    any_match,
    complete_group_max,
    dedupe_latest,
    first_per_group,
    latest_per_key,
    priority_rollup,
)
from reckon.operators.rules import Case, Rule, Stage, case_map, group_category, in_term_cancel, observe_labels, staged_status, waterfall
from reckon.sources.catalog import driver_tables
from reckon.sources.snapshot import newest_snapshot, previous_month_rows, write_snapshot


def _cat(spark: SparkSession, d: str):
    return driver_tables(spark, d)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _year_range(df: DataFrame, col: str, year: int):
    """``year(col) = year`` as a pushed-down range on the raw column."""
    lo = ts_literal(df, col, _dt.datetime(year, 1, 1))
    hi = ts_literal(df, col, _dt.datetime(year + 1, 1, 1))
    return (F.col(col) >= lo) & (F.col(col) < hi)


def _dbl(c) -> "F.Column":
    return c.cast("double")


# ---------------------------------------------------------------- scans / predicates


def q_scan_filter(spark, d):
    o = _t(spark, d, "orders")
    return o.where(
        ci_ne("o_orderstatus", "p") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & _year_range(o, "o_orderdate", 1997)
    )


def q_like_not_like(spark, d):
    p = _t(spark, d, "part")
    return p.where(ci_like("p_name", "small%") & ci_not_like("p_name", "%ring%")).select("p_partkey", "p_name", "p_brand")


def q_project_swap(spark, d):
    li = _t(spark, d, "lineitem")
    # One select: the swap is simultaneous (chained withColumn would not be).
    return li.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_tax").alias("l_discount"),
        F.col("l_discount").alias("l_tax"),
        F.col("l_returnflag").alias("return_flag"),
    )


def q_semi_in(spark, d):
    li = _t(spark, d, "lineitem")
    urgent = _t(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return semi_in(li, urgent, {"l_orderkey": "o_orderkey"})


def q_anti_not_in(spark, d):
    return anti_not_in(_t(spark, d, "orders"), _t(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"})


def q_blank_filter(spark, d):
    e = _t(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("event_type"), "value"
    )
    return blank_to_null(e).where(is_blank("event_type"))


def q_contains_literal(spark, d):
    p = _t(spark, d, "part")
    return p.where(contains_lit("p_type", "promo", ignore_case=True)).select("p_partkey", "p_type")


def q_mismatch_subset(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    j = lookup(li, _t(spark, d, "part"), {"l_partkey": "p_partkey"}, {"p_size": "ref_size"})
    return j.where(is_blank("ref_size") | ne_null_safe(F.col("ref_size").cast("double"), F.col("l_quantity"))).select(
        "l_orderkey", "l_linenumber", "l_quantity", "ref_size"
    )


def q_distinct_multi(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year")).distinct()


def q_latest_snapshot(spark, d):
    return latest_snapshot(_t(spark, d, "orders"), "o_orderdate")


def q_snapshot_prev_month(spark, d):
    e = _t(spark, d, "events")
    return previous_month_rows(e, "ts", _dt.date(2024, 2, 17)).select("event_id", "user_id", "event_type", "ts")


# ---------------------------------------------------------------- joins / lookups


def q_join_inner(spark, d):
    o = _t(spark, d, "orders").where(F.col("o_orderstatus") == "F")
    li = _t(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return o.join(li, o.o_orderkey == li.l_orderkey, "inner").select(
        "o_orderkey", "o_custkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )


def q_lookup_left(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(li, _t(spark, d, "part"), {"l_partkey": "p_partkey"}, {"p_brand": "brand", "p_retailprice": "retail_price"})


def q_lookup_concat_key(spark, d):
    c = _t(spark, d, "customer")
    seg = c.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_in_group"), F.sum(money("c_acctbal")).alias("seg_balance")
    )
    seg = seg.select(key_concat("c_nationkey", "c_mktsegment").alias("gkey"), "n_in_group", _dbl(F.col("seg_balance")).alias("seg_balance"))
    base = c.select("c_custkey", key_concat("c_nationkey", "c_mktsegment").alias("ckey"))
    return lookup(base, seg, {"ckey": "gkey"}, ["n_in_group", "seg_balance"])


def _avg(col):
    # Exact sum, then one IEEE division: the same value on every engine.
    return F.try_divide(F.sum(money(col)).cast("double"), F.count(col).cast("double"))


def q_lookup_fill_chain(spark, d):
    s = _t(spark, d, "supplier")
    n = _t(spark, d, "nation")
    s = s.select("s_suppkey", "s_nationkey", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("balance"))
    s = lookup(s, n, {"s_nationkey": "n_nationkey"}, {"n_regionkey": "s_regionkey"}, broadcast=True)
    nat = s.groupBy("s_nationkey").agg(_avg("balance").alias("nation_avg"))
    reg = s.groupBy("s_regionkey").agg(_avg("balance").alias("region_avg"))
    s = lookup(s, nat, "s_nationkey", {"nation_avg": "balance"}, mode="fill")
    s = lookup(s, reg, "s_regionkey", {"region_avg": "balance"}, mode="fill")
    return s.select("s_suppkey", "balance")


def q_lookup_overwrite(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    sums = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(_dbl(F.sum(money("l_extendedprice"))).alias("line_total"))
    return lookup(o, sums, {"o_orderkey": "l_orderkey"}, {"line_total": "o_totalprice"}, mode="overwrite")


def q_propagate_by_key(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    li = li.withColumn("order_flag", F.lit(None).cast("string"))
    out = propagate_by_key(
        li, "l_orderkey", "l_returnflag", "order_flag",
        order=["l_extendedprice desc", "l_linenumber desc", "l_returnflag desc"], pick="first", mode="fill",
    )
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "order_flag")


def q_left_join_on_filter(spark, d):
    c = _t(spark, d, "customer").select("c_custkey")
    o = _t(spark, d, "orders")
    of = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    return c.join(of, c.c_custkey == of.o_custkey, "left").select("c_custkey", "o_orderkey", "o_totalprice")


def q_left_where_inner(spark, d):
    c = _t(spark, d, "customer").select("c_custkey")
    o = _t(spark, d, "orders")
    # Written as the source wrote it (left join + WHERE on the right side);
    # Catalyst turns it into an inner join.
    j = c.join(o, c.c_custkey == o.o_custkey, "left").where(F.col("o_orderstatus") == "F")
    return j.select("c_custkey", "o_orderkey", "o_totalprice")


def q_open_rows_after_left(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    r = _t(spark, d, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey", "l_shipdate")
    j = o.join(r, o.o_orderkey == r.l_orderkey, "left")
    return j.where(F.col("l_shipdate").isNull()).select("o_orderkey", "o_orderstatus")


def q_star_join(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    # nation/region are code lists (25 and 5 rows by definition): safe to broadcast.
    n = F.broadcast(_t(spark, d, "nation").select("n_nationkey", "n_regionkey"))
    r = F.broadcast(_t(spark, d, "region").select("r_regionkey", "r_name"))
    p = _t(spark, d, "part").select("p_partkey", "p_brand")
    s = _t(spark, d, "supplier").select("s_suppkey")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .join(p, F.col("l_partkey") == p.p_partkey)
        .join(s, F.col("l_suppkey") == s.s_suppkey)
    )
    return j.groupBy("r_name", "p_brand").agg(
        _dbl(F.sum(money("l_extendedprice"))).alias("revenue"), F.count(F.lit(1)).alias("n_lines")
    )


def q_role_playing_dim(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey).join(s, F.col("l_suppkey") == s.s_suppkey)
    j = role_dims(j, _t(spark, d, "nation"), "n_nationkey", {"cust": "c_nationkey", "supp": "s_nationkey"}, ["n_name"], bounded=True)
    return j.select("l_orderkey", "l_linenumber", F.col("cust_n_name").alias("cust_nation"), F.col("supp_n_name").alias("supp_nation"))


# Event types of the attribute table (fixed values).
EVENT_TYPES = ["view", "click", "signup", "error", "purchase"]


def q_typed_id_pivot(spark, d):
    e = _t(spark, d, "events")
    return pivot_typed_ids(e, "user_id", "event_type", "event_id", {t: f"last_{t}" for t in EVENT_TYPES}, order_col="ts")


def q_typed_id_fanout(spark, d):
    """Suppliers of each order by return flag, every one kept."""
    return fan_out_typed_ids(_t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "l_suppkey", {f: f"supplier_{f.lower()}" for f in "RAN"})


def q_eav_pivot(spark, d):
    e = _t(spark, d, "events")
    attrs = pivot_attributes(e, "user_id", "event_type", "value", {t: f"max_{t}" for t in EVENT_TYPES})
    users = _t(spark, d, "customer").select("c_custkey")
    return lookup(users, attrs, {"c_custkey": "user_id"}, [f"max_{t}" for t in EVENT_TYPES])


def q_join_expr_key(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, d, "customer").select("c_name")
    j = o.join(c, F.right(F.col("c_name"), F.lit(9)).cast("bigint") == o.o_custkey, "inner")
    return j.select(
        "o_orderkey", "o_custkey", "c_name",
        F.col("o_custkey").cast("string").alias("key_text"),
        F.lit(None).cast("string").alias("ma_piid"),
    )


def q_lookup_first_ordered(spark, d):
    """Lookup against a reference with many rows per key: the customer's
    latest order (ties by the larger order key) is taken, one row per
    customer is kept."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    o = _t(spark, d, "orders")
    return lookup(c, o, {"c_custkey": "o_custkey"}, {"o_orderkey": "last_order", "o_orderdate": "last_order_date"},
                  on_multi="first", order=["o_orderdate desc", "o_orderkey desc"])


def q_propagate_last(spark, d):
    """Last-wins propagation: the flag of the line with the latest ship date
    (ties: larger line number, then flag) fills every line of the order."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    li = li.withColumn("order_flag", F.lit(None).cast("string"))
    out = propagate_by_key(li, "l_orderkey", "l_returnflag", "order_flag",
                           order=["l_shipdate", "l_linenumber", "l_returnflag"], pick="last", mode="fill")
    return out.select("l_orderkey", "l_linenumber", "order_flag")


def q_first_per_group_mixed(spark, d):
    """First line per order under a mixed-direction order: quantity desc,
    ship date asc, line number asc, price desc."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_extendedprice")
    return first_per_group(li, "l_orderkey", ["l_quantity desc", "l_shipdate asc", "l_linenumber asc", "l_extendedprice desc"])


def q_waterfall_keep_existing(spark, d):
    """Rules only fill rows without a reason: pending orders arrive with a
    reason already set and keep it."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = o.withColumn("reason", F.when(F.col("o_orderstatus") == "P", F.lit("Pre-set"))).withColumn(
        "category", F.when(F.col("o_orderstatus") == "P", F.lit("Held")))
    rules = [
        Rule("Urgent", "Actionable", F.col("o_orderpriority") == "1-URGENT"),
        Rule("Large", "NonActionable", F.col("o_totalprice") > 300000),
    ]
    out = waterfall(o, rules, ("Proceed", "Actionable"), keep_existing=True)
    return out.select("o_orderkey", "reason", "category")


# ---------------------------------------------------------------- aggregations / windows


def _orders_by_month(o: DataFrame, year: int) -> DataFrame:
    o = o.where(_year_range(o, "o_orderdate", year))
    return sum_by_month(o, ["o_orderpriority", "o_orderstatus"], "o_orderdate", "o_totalprice", None, out="sum_price", month_col="month")


def q_agg_sum_by_month(spark, d):
    g = _orders_by_month(_t(spark, d, "orders"), 1997)
    return g.select("o_orderpriority", "o_orderstatus", "month", _dbl(F.col("sum_price")).alias("sum_price"))


def q_group_amount_match(spark, d):
    # Per order: the amount (sum of the first lines) against the current
    # value (largest line) and the new value (smallest line): equal to the
    # current -> Proceed; equal to neither -> Cancel; else Unchanged.
    li = _t(spark, d, "lineitem")
    g = li.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_linenumber") == 1, money("l_extendedprice"))).alias("amount"),
        F.max(money("l_extendedprice")).alias("current_amt"),
        F.min(money("l_extendedprice")).alias("new_amt"),
    )
    status = (
        F.when(F.col("amount") == F.col("current_amt"), F.lit("Proceed"))
        .when(F.col("amount") != F.col("new_amt"), F.lit("Cancel"))
        .otherwise(F.lit("Unchanged"))
    )
    return g.select(
        "l_orderkey", _dbl(F.col("amount")).alias("amount"), _dbl(F.col("current_amt")).alias("current_amt"),
        _dbl(F.col("new_amt")).alias("new_amt"), status.alias("amount_status"),
    )


def q_any_match_group(spark, d):
    return any_match(_t(spark, d, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R", "has_return")


# Return-flag ranking for the priority roll-ups (fixed values, highest first).
FLAG_RANKING = ["R", "A", "N"]


def q_priority_rollup(spark, d):
    return priority_rollup(_t(spark, d, "lineitem"), "l_partkey", "l_returnflag", FLAG_RANKING, "N", "part_flag")


def q_priority_rollup_default(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    out = priority_rollup(li, "l_partkey", "l_returnflag", ["R", "A"], None, "part_flag", per_row=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "part_flag")


def q_complete_group_max(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    per_order = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("order_last_ship"))
    per_order = per_order.withColumn("found", F.lit(True))
    o = lookup(o, per_order, {"o_orderkey": "l_orderkey"}, ["order_last_ship", "found"])
    return complete_group_max(o, "o_custkey", "order_last_ship", F.col("found"), "last_ship")


def q_latest_per_key_ties(spark, d):
    o = _t(spark, d, "orders")
    return latest_per_key(o, "o_custkey", "o_orderdate", where=F.col("o_orderstatus") != "P").select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )


def q_first_per_group_nulls_first(spark, d):
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_shipdate")).alias("first_date")
    )
    return first_per_group(li, "l_orderkey", ["first_date desc nulls first"])


def q_dedupe_latest(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedupe_latest(o, "o_custkey", "o_orderdate", tie="o_orderkey")


def q_sort_multi(spark, d):
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return s.orderBy(F.col("s_nationkey").asc(), F.col("s_acctbal").desc(), F.col("s_suppkey").asc())


def q_union_by_name(spark, d):
    o = _t(spark, d, "orders")
    f = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    p = o.where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return f.unionByName(p, allowMissingColumns=True)


# ---------------------------------------------------------------- scalar functions


def q_str_funcs(spark, d):
    c = _t(spark, d, "customer")
    digits = F.right(F.col("c_name"), F.lit(9))
    return c.select(
        "c_custkey",
        concat_strict("c_name", "c_mktsegment").alias("name_seg"),
        F.substr(F.col("c_name"), F.lit(4)).alias("name_tail"),
        digits.alias("name_digits"),
        digits.rlike("^[0-9]+$").alias("all_digits"),
        F.substring_index("c_name", "#", -1).rlike("^[0-9]{11,}$").alias("long_digits"),
    )


def q_date_funcs(spark, d):
    o = _t(spark, d, "orders")
    od = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        mdy("o_orderdate").alias("order_mdy"),
        prev_month_abbr(od).alias("prev_mon"),
        check_date(od).alias("check_date"),
        cycle_date(F.year(od), F.month(od), 31).alias("cycle_date"),
    )


def q_safe_cast(spark, d):
    e = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        "event_id",
        safe_num(k, "int").alias("k_num"),
        safe_date(F.concat(F.lit("2024-01-"), k), "yyyy-MM-d").cast("timestamp_ntz").alias("k_date"),
    )


def q_scale_amount(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / 100).alias("price_hundredths"),
        scale_by_decimals("l_extendedprice", F.col("l_linenumber") % 3).alias("price_scaled"),
    )


def q_clamped_diff(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    j = lookup(li, _t(spark, d, "part"), {"l_partkey": "p_partkey"}, ["p_retailprice"])
    diff = clamped_diff(money("l_extendedprice"), money("l_quantity") * money("p_retailprice"))
    return j.select("l_orderkey", "l_linenumber", _dbl(diff).alias("diff"))


def q_period_compare_yyyymm(spark, d):
    o = _t(spark, d, "orders")
    o = o.where(F.col("o_orderdate") >= ts_literal(o, "o_orderdate", _dt.datetime(1997, 6, 1)))
    p = yyyymm("o_orderdate")
    return o.select("o_orderkey", p.alias("period"), period_year(p).alias("p_year"), period_month(p).alias("p_month"))


def q_period_compare(spark, d):
    """Flagship: month-over-month style comparison, 1996 vs 1997 order
    value by priority / status / month, with percent change and flags."""
    o = _t(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice")
    # Both years come from the same table: one scan, one aggregate with a
    # conditional sum per year, no join (the year range reaches the scan).
    lo = ts_literal(o, "o_orderdate", _dt.datetime(1996, 1, 1))
    hi = ts_literal(o, "o_orderdate", _dt.datetime(1998, 1, 1))
    o = o.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).withColumn("month", F.month("o_orderdate"))
    return compare_periods(o, ["o_orderpriority", "o_orderstatus", "month"], F.year("o_orderdate"), 1996, 1997, "o_totalprice")


# ---------------------------------------------------------------- rule cascades


def q_case_rules(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    is_o = F.col("o_orderstatus") == "O"
    out = case_map(
        o,
        [
            Case(is_o & (F.col("o_orderpriority") == "1-URGENT"), {"new_status": "Canceled", "reason": "Renewal", "note": "Renewal per validator"}),
            Case(is_o & (F.col("o_orderpriority") == "2-HIGH"), {"new_status": "Canceled", "reason": "Disconnect", "note": "Disconnect per validator"}),
        ],
        {"new_status": None, "reason": None, "note": None},
    )
    row_status = (
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") != 0), F.lit("Proceed with Rerate"))
        .when(F.col("o_orderstatus") == "P", F.lit("Proceed with Reversal"))
    )
    return out.select("o_orderkey", "new_status", "reason", "note", row_status.alias("row_status"))


def q_cycle_date_fix(spark, d):
    li = _t(spark, d, "lineitem")
    cd = cycle_date(2025, 6, 31)
    return li.select("l_orderkey", "l_linenumber", F.when(F.col("l_shipdate").isNotNull(), cd).alias("fixed_date"))


def q_flag_repair(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    j = lookup(li, _t(spark, d, "part"), {"l_partkey": "p_partkey"}, ["p_type"])
    f = F.col("l_returnflag")
    repaired = F.when(is_blank(f) | (f == "N"), F.when(contains_lit("p_type", "PROMO", ignore_case=True), F.lit("N")).otherwise(F.lit("Y"))).otherwise(f)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", repaired.alias("repaired_flag"))


def _rule_star(spark, d) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_discount")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = _t(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    p = _t(spark, d, "part").select("p_partkey", "p_type", "p_size")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(p, F.col("l_partkey") == p.p_partkey)
    )


# Rule list of the registry cascade (fixed labels and categories, in order).
STAR_RULES = [
    ("Negative balance", "NonActionable", lambda: F.col("c_acctbal") < 0),
    ("Pending order", "NonActionable", lambda: F.col("o_orderstatus") == "P"),
    ("Promo return", "Actionable", lambda: (F.col("l_returnflag") == "R") & contains_lit("p_type", "promo", ignore_case=True)),
    ("Returned", "NonActionable", lambda: F.col("l_returnflag") == "R"),
    ("Automobile segment", "NonActionable", lambda: F.col("c_mktsegment") == "AUTOMOBILE"),
    ("High discount", "Potentially Actionable", lambda: F.col("l_discount") >= 0.09),
    ("Large part", "NonActionable", lambda: F.col("p_size") > 45),
    ("Urgent", "Actionable", lambda: F.col("o_orderpriority") == "1-URGENT"),
]
STAR_DEFAULT = ("Proceed", "Actionable")


def _waterfall_star(spark, d) -> DataFrame:
    rules = [Rule(label, cat, cond()) for label, cat, cond in STAR_RULES]
    return waterfall(_rule_star(spark, d), rules, STAR_DEFAULT)


def q_rule_waterfall(spark, d):
    return _waterfall_star(spark, d).select("l_orderkey", "l_linenumber", "reason", "category")


def q_group_actionable(spark, d):
    from reckon.session import cut_lineage

    w = _waterfall_star(spark, d).select("l_orderkey", "l_linenumber", "o_custkey", "category")
    return group_category(w, "o_custkey", "category", "Actionable", "customer_actionable", cut=cut_lineage)


def q_staged_status(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    out = staged_status(
        li,
        "status",
        [
            Stage("fill", F.col("l_returnflag") == "R", "Returned"),
            Stage("fill", F.col("l_linestatus") == "O", "Open"),
            Stage("overwrite", F.col("l_quantity") > 48, "Bulk"),
            Stage("fill", F.col("l_discount") == 0, "No discount"),
            Stage("overwrite", (F.col("l_tax") > 0.07) & (F.col("l_returnflag") == "A"), "Taxed accepted"),
        ],
    )
    return out.select("l_orderkey", "l_linenumber", "status")


def q_exception_rule(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    cancel = in_term_cancel(
        F.col("l_shipdate"), ts_literal(li, "l_shipdate", _dt.datetime(1998, 6, 30)),
        F.col("o_orderpriority"), F.col("o_orderstatus"), F.add_months(F.col("o_orderdate"), 36),
        "5-LOW", "4-NOT SPECIFIED", "F",
    )
    return j.select("l_orderkey", "l_linenumber", F.when(cancel, F.lit("Cancel - Circuit in term")).alias("status"))


# ---------------------------------------------------------------- jobs on the driver tables

# Status texts of the cycle preparation (fixed values).
ST_DISCONNECT = "Cancel - Disconnect"
ST_MOVE_BACK = "Move back to complete - Reversal cannot be completed due to disconnect"
ST_MRR = "Cancel for MRR Cost Change"


def _cycle_base(li: DataFrame) -> DataFrame:
    scid = F.when(F.col("l_linenumber") % 2 == 1, F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))).otherwise(
        F.col("l_partkey").cast("string")
    )
    common = [
        F.col("l_orderkey").alias("piid"), F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supp_id"), scid.alias("scid"),
    ]
    rerates = li.where(F.col("l_returnflag") == "R").select(
        *common, F.col("l_discount").alias("cur_rate"), F.col("l_tax").alias("new_rate"), F.lit("rerate").alias("kind")
    )
    # Reversals: old and new rate swapped in one projection; any reversal
    # date present is set to the cycle date.
    reversals = li.where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).select(
        *common, F.col("l_tax").alias("cur_rate"), F.col("l_discount").alias("new_rate"), F.lit("reversal").alias("kind"),
        F.when(F.col("l_shipdate").isNotNull(), cycle_date(2025, 6, 31)).alias("reversal_date"),
    )
    return rerates.unionByName(reversals, allowMissingColumns=True)


def q_cycle_prep_mini(spark, d):
    """Cycle preparation stages on the driver tables: union of rerates and
    reversals, billed-rate replace, active fill + propagation per instance,
    estimated-rate fill for split ids, clamped difference, disconnect and
    cost-change statuses, term end with fallback, instance roll-up."""
    li = _t(spark, d, "lineitem")
    base = _cycle_base(li).withColumn("unique", key_concat("part_id", "supp_id"))
    billed = li.where(F.col("l_linestatus") == "F").groupBy(key_concat("l_partkey", "l_suppkey").alias("bkey")).agg(
        F.max("l_discount").alias("rate")
    )
    df = lookup(base, billed, {"unique": "bkey"}, {"rate": "billed"})
    # a supplier in debt has no active value
    sup = _t(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("active"))
    df = lookup(df, sup, {"supp_id": "s_suppkey"}, ["active"])
    df = propagate_by_key(df, "piid", "active", "active", order=["line_no", "supp_id"], pick="first", mode="fill")
    part = _t(spark, d, "part").select("p_partkey", (F.col("p_retailprice") / 10000).alias("est_rate"))
    df = lookup(df, part, {"part_id": "p_partkey"}, ["est_rate"])
    df = df.withColumn(
        "billed", F.when(contains_lit("scid", "-") & is_blank("billed"), F.col("est_rate")).otherwise(F.col("billed"))
    ).drop("est_rate")
    df = df.withColumn("difference", clamped_diff("cur_rate", "billed"))
    # Per-order facts from one aggregate: any disconnect line, last ship date.
    per_order = li.groupBy("l_orderkey").agg(
        F.bool_or(F.coalesce((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit(False))).alias("has_disconnect"),
        F.max("l_shipdate").alias("last_ship"),
    )
    df = lookup(df, per_order, {"piid": "l_orderkey"}, ["has_disconnect", "last_ship"])
    df = staged_status(
        df,
        "status",
        [
            Stage("fill", is_blank("billed") & (F.col("kind") == "reversal") & F.col("has_disconnect"), ST_MOVE_BACK),
            Stage("fill", is_blank("billed") & F.col("has_disconnect"), ST_DISCONNECT),
            Stage("fill", F.col("difference").isNull() | (F.col("difference") != 0), ST_MRR),
        ],
    ).drop("has_disconnect")
    o = _t(spark, d, "orders")
    primary = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate")
    df = lookup(df, primary, {"piid": "o_orderkey"}, {"o_orderdate": "term_end"})
    df = df.withColumn("term_end", F.coalesce(F.col("term_end"), F.col("last_ship"))).drop("last_ship")
    df = priority_rollup(df, "piid", "status", [ST_DISCONNECT, ST_MOVE_BACK, ST_MRR], None, "piid_status", per_row=True)
    return df.select(
        "piid", "line_no", "scid", "kind", "cur_rate", "new_rate", "billed", "active", "difference", "status", "term_end",
        "piid_status", "reversal_date",
    )


# Labels and categories of the classification cascade (fixed values).
CLASSIFY_RULES = [
    ("Not in margin base", "NonActionable"),
    ("Negative balance", "NonActionable"),
    ("Pending", "NonActionable"),
    ("In Term - Urgent", "Actionable"),
    ("In Term", "NonActionable"),
    ("Service is $0 Biller", "Actionable"),
]
CLASSIFY_DEFAULT = ("Proceed with Rerate", "Actionable")


def q_classify_mini(spark, d):
    """Classification on the driver tables: input list (customers), margin
    base (their latest order), anti-join for the missing ones, lookups,
    then one first-match waterfall."""
    c = _t(spark, d, "customer").select("c_custkey", "c_acctbal")
    o = _t(spark, d, "orders")
    margin = dedupe_latest(
        o.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"),
        "o_custkey", "o_orderdate", tie="o_orderkey",
    )
    missing = anti_not_in(c, margin, {"c_custkey": "o_custkey"}).select("c_custkey", F.lit(True).alias("missing"))
    df = lookup(c, margin, {"c_custkey": "o_custkey"}, ["o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    df = lookup(df, missing, "c_custkey", ["missing"])
    chk = check_date(F.lit(_dt.date(1997, 6, 15)))
    conds = [
        F.coalesce(F.col("missing"), F.lit(False)),
        F.col("c_acctbal") < 0,
        F.col("o_orderstatus") == "P",
        (F.to_date("o_orderdate") > chk) & (F.col("o_orderpriority") == "1-URGENT"),
        F.to_date("o_orderdate") > chk,
        F.col("o_totalprice") == 0,
    ]
    rules = [Rule(label, cat, cond) for (label, cat), cond in zip(CLASSIFY_RULES, conds)]
    return waterfall(df, rules, CLASSIFY_DEFAULT).select("c_custkey", "reason", "category")


def q_validator_mini(spark, d):
    """Validator update on the driver tables: DISTINCT over a filtered join,
    then a projection (no second DISTINCT) and the disposition mapping."""
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    j = o.join(li, o.o_orderkey == li.l_orderkey).where(
        ci_not_like("o_orderpriority", "%low%") & ci_ne("o_orderstatus", "p")
        & (F.col("o_orderdate") >= ts_literal(o, "o_orderdate", _dt.datetime(1996, 1, 1)))
        & (F.col("o_orderdate") < ts_literal(o, "o_orderdate", _dt.datetime(1998, 1, 1)))
    )
    dist = j.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus").distinct()
    is_o = F.col("o_orderstatus") == "O"
    out = case_map(
        dist,
        [
            Case(is_o & (F.col("l_returnflag") == "R"), {"workflow_status": "Canceled", "non_opp_reason": "Renewal", "notes": "Renewal per validator"}),
            Case(is_o & (F.col("l_returnflag") == "A"), {"workflow_status": "Canceled", "non_opp_reason": "Disconnect", "notes": "Disconnect per validator"}),
        ],
        {"workflow_status": None, "non_opp_reason": None, "notes": None},
    )
    return out.select("o_orderkey", "o_custkey", "workflow_status", "non_opp_reason", "notes")


def q_forecast_compare_job(spark, d):
    """J1 through the job API on the driver tables: history = order values
    per (priority, status, month) in two snapshots (the older holds only the
    pending orders and must be ignored), current = the summed line values."""
    from reckon.plans.forecast import forecast_compare

    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    cols = [F.col("o_orderpriority").alias("initiative"), F.col("o_orderstatus").alias("rerate_type"), F.col("o_orderdate").alias("rerate_month")]
    hist = o.select(*cols, F.col("o_totalprice").alias("increase"), F.lit(_dt.date(2025, 5, 28)).cast("timestamp_ntz").alias("finalized_date"))
    older = o.where(F.col("o_orderstatus") == "P").select(
        *cols, (F.col("o_totalprice") * 2).alias("increase"), F.lit(_dt.date(2025, 4, 28)).cast("timestamp_ntz").alias("finalized_date"))
    lines = li.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("increase"))
    curr = o.join(lines, o.o_orderkey == lines.l_orderkey).select(*cols, F.col("increase").cast("double").alias("increase"))
    return forecast_compare(hist.unionByName(older), curr, 1997, "may", "june")["compare"]


def q_validator_job(spark, d):
    """J2 through the job API: the validation log is derived from orders,
    the rate header from lineitem (one header row per line), then the real
    ``validator_update`` (filters, 13-column DISTINCT, projection without a
    second DISTINCT, disposition mapping) runs for cycle 6/15/1997."""
    from reckon.plans.validator import validator_update

    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    disposition = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Disconnect"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Canceled due to Renewal"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Overlap found"))
        .otherwise(F.lit("Other"))
    )
    log = o.select(
        F.col("o_orderkey").cast("string").alias("piid_meid"), F.col("o_custkey").cast("string").alias("product_inst_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Red")).otherwise(F.lit("GREEN")).alias("redblue"),
        F.col("o_orderpriority").alias("subprojname"),
        F.when(F.col("o_orderstatus") == "O", F.lit("In Progress")).otherwise(F.lit("Complete")).alias("workflowstatus"),
        F.month("o_orderdate").alias("rerate_month"), F.year("o_orderdate").alias("fiscalyear"), F.col("o_orderdate").alias("disconnectdate"),
        disposition.alias("disposition"), F.col("o_orderstatus").alias("disconnected"), F.lit(None).cast("timestamp_ntz").alias("dtedisconnected"),
    )
    header = li.select(
        F.col("l_orderkey").cast("string").alias("piid_meid"),
        F.when(F.col("l_returnflag") == "R", F.lit("Canceled")).otherwise(F.lit("Open")).alias("workflowstatus"),
        F.month("l_shipdate").alias("rerate_month_actual"), F.dayofmonth("l_shipdate").alias("invoice_day"),
        F.year("l_shipdate").alias("fiscalyear"), F.col("l_linestatus").alias("non_opp_reason"),
    )
    return validator_update(log, header, 6, 15, 1997)


def classify_inputs(spark, d) -> dict:
    """The classification's inputs derived from the driver tables (names
    as in FIXTURES.md); the run date is 1997-06-17 (check date 1997-09-01,
    previous snapshot 199705)."""
    c = _t(spark, d, "customer")
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    ds = lambda col: F.date_format(col, "yyyy-MM-dd")
    margin_service = o.select(
        F.col("o_orderkey").cast("string").alias("ecckt_aml_id"), name.alias("ecckt_stripped_name"),
        F.col("o_orderpriority").alias("sap_account_cd"), F.col("o_orderkey").cast("string").alias("rev_product_compnt_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("rev_mrr"),
        F.col("o_custkey").cast("string").alias("solution_id_prime"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Y")).otherwise(F.lit("N")).alias("gov_ind"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CABS")).otherwise(F.lit("KEN")).alias("bill_src_sys_cd"),
        ds(F.col("o_orderdate")).alias("last_rerate_date"), F.lit(199706).alias("jrnl_yr_mnth_nbr"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("Contractual")).alias("dnt_reason_code"),
        ds(F.date_add(F.to_date("o_orderdate"), 120)).alias("hold_expiration_date"), F.lit(None).cast("string").alias("dnt_exclusion_level"),
    )
    margin_circuit = c.select(
        F.col("c_custkey").cast("string").alias("solution_id_prime"), F.col("c_mktsegment").alias("product_concat"),
        F.lit("BU").alias("business_unit"), F.lit("R").alias("rev_region_concat"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Y")).otherwise(F.lit("N")).alias("in_term_tdm_rr"),
        ds(F.date_add(F.lit(_dt.date(1997, 6, 1)), (F.col("c_custkey") % 400).cast("int"))).alias("customer_term_end_dt"),
        F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("rev_mrr"),
        F.when(F.col("c_nationkey") < 20, F.lit("NA")).otherwise(F.lit("EMEA")).alias("occ_region_concat"),
    )
    gl_account = o.select(F.col("o_orderpriority").alias("gl_account_cd")).distinct().select(
        "gl_account_cd",
        F.when(F.col("gl_account_cd") == "2-HIGH", F.lit("Disco Shelf GL")).otherwise(F.concat(F.lit("GL "), F.col("gl_account_cd"))).alias("gl_account_desc"),
        F.when(F.col("gl_account_cd") == "3-MEDIUM", F.lit("Fixed Netex")).otherwise(F.lit("Direct Netex")).alias("gl_account_ess_tier3_desc"),
    )
    snap = lambda period: c.select(
        F.col("c_name").alias("stripped_ec_circuit_id"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("active_ind"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(2)).otherwise(F.lit(1)).alias("dw_secure_company_nbr"), F.lit(period).alias("snapshot"),
    )
    billing = li.select(F.col("l_orderkey").cast("string").alias("primary_type_1"),
                        F.when(F.col("l_linestatus") != "O", ds(F.col("l_shipdate"))).alias("billing_inactive_dt"))
    history = o.select(
        F.col("o_custkey").cast("string").alias("product_inst_id"), F.col("o_orderkey").cast("string").alias("serv_comp_id"),
        F.col("o_orderkey").cast("string").alias("piid_meid"), F.col("o_orderpriority").alias("subprojname"),
        F.col("o_orderdate").alias("rerate_date"), F.col("o_totalprice").alias("increase"),
        F.when(F.col("o_orderstatus") == "O", F.lit("In Progress")).when(F.col("o_orderstatus") == "F", F.lit("Complete"))
        .otherwise(F.lit("Canceled")).alias("workflowstatus"),
    )
    return dict(
        circuits=c.select(F.col("c_custkey").cast("string").alias("ecckt_aml_id"), F.col("c_name").alias("ecckt_stripped_name")),
        margin_service=margin_service, margin_circuit=margin_circuit, gl_account=gl_account,
        expense_snapshot=snap(199705).unionByName(snap(199704)), billing=billing, rerate_history=history,
    )


def q_classify_job(spark, d):
    """J4 through the job API (all 23 rules) on inputs derived from the
    driver tables; one row per input circuit x margin service row."""
    from reckon.plans.classify import classify_circuits

    out = classify_circuits(run_date=_dt.date(1997, 6, 17), **classify_inputs(spark, d))["final"]
    return out.select("input_ecckt_aml_id", "rev_product_compnt_id", "nonactionable_reason", "actionable_nonactionable", "piid_any_actionable")


def cycle_inputs(spark, d) -> dict:
    """The cycle preparation's inputs derived from the driver tables (names
    as in FIXTURES.md). Header = orders, detail = lineitem; the cycle is
    June 1997, invoice day 31 (cycle date 1997-06-30)."""
    from reckon.session import cut_lineage

    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem")
    p = _t(spark, d, "part")
    piid = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("PK-"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))).otherwise(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")))
    header = o.select(
        F.col("o_orderkey").cast("string").alias("piid_meid"), piid.alias("product_inst_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("red")).otherwise(F.lit("Green")).alias("redblue"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("In Term TDM Cost Increase Pass Thru"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Offnet TDM Discontinuance"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Core Access")).otherwise(F.lit("Core")).alias("subprojname"),
        F.when(F.col("o_orderstatus") == "O", F.lit("In Progress"))
        .when((F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 1997), F.lit("Reversal"))
        .when(F.col("o_orderstatus") == "F", F.lit("Complete")).otherwise(F.lit("canceled")).alias("workflowstatus"),
        F.month("o_orderdate").alias("rerate_month_actual"), F.year("o_orderdate").alias("fiscalyear"), F.lit(31).alias("invoice_day"),
        F.lit("MRC").alias("frequency"), F.lit("BO").alias("bus_org_id"), F.lit("prod").alias("product"),
        F.lit("ch").alias("cust_acct_sales_channel_desc"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("WHOLESALE")).otherwise(F.lit("RETAIL")).alias("business_unit"),
        F.add_months(F.col("o_orderdate"), 36).cast("timestamp_ntz").alias("cust_contract_term_end_dt"),
        F.lit(None).cast("string").alias("non_opp_reason"),
        (F.col("o_totalprice") / 10000).alias("piid_current_rate"), (F.col("o_totalprice") / 5000).alias("piid_new_rate"),
        F.concat(F.lit("I"), F.col("o_custkey").cast("string")).alias("inv_ban"),
    )
    cid = F.when(F.col("l_linenumber") == 7, F.lit("pk")).when(F.col("l_linenumber") % 3 == 0, F.lit("X-")).otherwise(F.lit("CI"))
    grp = F.lpad(F.col("l_partkey").cast("string"), 8, "0")
    comp = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    lx = li.select("*", cid.alias("cid"), grp.alias("grp"), comp.alias("comp"))
    scid = F.concat(F.col("cid"), F.col("grp"))
    detail = lx.select(
        F.col("l_orderkey").cast("string").alias("rr_piid_meid"), scid.alias("serv_comp_id"), F.col("cid").alias("component_id"),
        F.col("grp").alias("component_grp_val_id"), F.col("comp").alias("component"), F.col("l_discount").alias("scp_current_rate"),
        F.col("l_tax").alias("scp_increase"), (F.col("l_discount") + F.col("l_tax")).alias("scp_new_rate"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("SE"), F.col("l_linenumber").cast("string"))).alias("service_element_id"),
        F.when(F.col("l_returnflag") == "A", F.lit("xpkg")).alias("promo_code"), F.lit("PC").alias("prod_cmpnt_cd"),
        F.when(F.col("l_returnflag") == "N", F.lit("N")).when(F.col("l_returnflag") == "R", F.lit("Y")).alias("pre_billed_ind"),
        F.lit("Y").alias("rollup_to_piid"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit("Other")).otherwise(F.lit("Latis")).alias("dw_source_system_cd"),
        F.col("l_shipdate").alias("rerate_date"), F.lit("m").alias("meid"), F.lit("PA").alias("prod_acct_id"), F.lit("b").alias("batch"),
        F.lit("BA").alias("bill_acct_nbr"), F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("reversal_date"),
        F.lit(None).cast("string").alias("reversal_reason"), F.lit("k").alias("invoice_kenan_acct_nbr"),
    )
    billed = lx.where(F.col("l_linestatus") == "F").select(scid.alias("primary_id"), F.col("comp").alias("prcmp_desc"), F.col("l_discount").alias("rate"))
    active = lx.where(F.col("l_linestatus") == "O").groupBy("cid", "grp", "comp", "l_partkey").agg(F.max("l_tax").alias("monthly_rev_est")).select(
        F.col("cid").alias("component_group_cd"), F.col("grp").alias("component_grp_val"), F.lit("PID").alias("prcmp_id"), F.lit("PR").alias("prcmp_code"),
        F.col("comp").alias("prcmp_dsc"), F.concat(F.lit("PC"), (F.col("l_partkey") % 7).cast("string")).alias("product_code"), "monthly_rev_est",
        F.lit("CA").alias("customer_acct_id"), F.lit("PAID").alias("product_account_id"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit("PKA")).alias("pkg_acct_id"), F.lit("Pack").alias("pkg_dsc"),
    )
    active = cut_lineage(active)  # read twice
    qguide = p.select(
        F.concat(F.lit("PC"), (F.col("p_partkey") % 7).cast("string"), F.lit("PR")).alias("unique_product_prcmp"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("Always > 1")).when(F.col("p_partkey") % 7 == 1, F.lit("Could be > 1 or = 1"))
        .otherwise(F.lit("Always = 1")).alias("quantity_status"),
    ).distinct()
    billing_rates = lx.where(F.col("l_returnflag") == "R").select(
        scid.alias("primary_type_1"), F.when(F.col("l_linenumber") != 4, F.col("l_discount") + F.lit(0.01)).alias("bill_rate"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("product_inactive_dt"), F.col("l_shipdate").alias("product_active_dt"))
    ol = o.select("o_orderkey", piid.alias("o_piid"))
    lo = lx.join(ol, lx.l_orderkey == ol.o_orderkey)
    account_rates = lo.where(F.col("l_returnflag") == "A").select(
        F.col("o_piid").alias("common_ckt"), F.col("l_discount").alias("monthly_rev_est"), F.col("l_shipdate").alias("bill_eff_bgn_date"))
    ses = lx.select(scid.alias("service_id"),
                    F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit("Disconnect")).otherwise(F.lit("Change")).alias("service_action"))
    term_primary = lx.where(F.col("l_returnflag") == "R").select(
        scid.alias("circuit_scid"), F.lit("x").alias("circuit_piid"), F.add_months(F.col("l_shipdate"), 12).cast("timestamp_ntz").alias("r4_termenddate"))
    term_fallback = lo.where(F.col("l_returnflag") == "A").select(
        F.col("cid").alias("component_group_cd"), F.col("grp").alias("scid"), F.col("o_piid").alias("piid"),
        F.add_months(F.col("l_shipdate"), 24).cast("timestamp_ntz").alias("service_end_date"))
    seid = lx.where(F.col("l_returnflag") == "R").groupBy("cid", "grp", "comp").agg(F.max("l_partkey").alias("pk")).select(
        F.col("cid").alias("component_group_cd"), F.col("grp").alias("component_grp_val"), F.col("comp").alias("prcmp_dsc"),
        F.concat(F.lit("SEX"), F.col("pk").cast("string")).alias("service_element_id"), F.lit("PCX").alias("prcmp_code"))
    return {
        "rate_detail": detail, "rate_header": header, "billed_records": billed, "active_products": active, "quantity_guide": qguide,
        "billing_rates": billing_rates, "account_rates": account_rates, "ses": ses, "term_primary": term_primary,
        "term_fallback": term_fallback, "service_elements": seid,
    }


CYCLE_OUT = ["serv_comp_id", "product_inst_id", "unique", "is_reversal", "scp_current_rate", "scp_new_rate", "kenan", "latis_active",
             "difference", "status", "qty", "r4_term_end_date", "pkg_cgv", "pkg_status", "pkg_description", "service_element_id",
             "prod_cmpnt_cd", "pre_billed_ind", "piid_level_status", "reversal_date"]


def q_cycle_prep_job(spark, d):
    """J3 through the job API (all 17 stages, package status built from the
    active products and the header) on inputs derived from the driver tables."""
    from reckon.plans.cycle_prep import cycle_prep

    return cycle_prep(cycle_inputs(spark, d), 1997, 6, 31)["rr_scid"].select(*CYCLE_OUT)


# ---------------------------------------------------------------- production pulls


def billing_tables(spark, d) -> dict[str, DataFrame]:
    """The relations of the billing pull, derived from the driver tables: products = line items,
    services and external ids = parts, accounts = customers, code tables = nations and regions."""
    li, p, c = _t(spark, d, "lineitem"), _t(spark, d, "part"), _t(spark, d, "customer")
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    old = F.lit(_dt.datetime(2020, 1, 1)).cast("timestamp_ntz")
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("view_id")
    track = [F.col("l_orderkey").alias("tracking_id"), F.col("l_linenumber").alias("tracking_id_serv")]
    sub = [F.col("p_partkey").alias("subscr_no"), (F.col("p_partkey") % 2).alias("subscr_no_resets")]

    def ids(prefix, kind, where, inactive=None):
        return p.where(where).select(*sub, F.concat(F.lit(prefix), F.col("p_partkey").cast("string")).alias("external_id"), F.lit(kind).alias("external_id_type"),
                                     (F.when(F.expr(inactive), old) if inactive else F.lit(None).cast("timestamp_ntz")).alias("inactive_date"))

    id_map = ids("C", 1, "p_partkey % 9 <> 0", "p_partkey % 5 = 0")
    for x in (ids("D", 1, "p_partkey % 15 = 0"), ids("P", 5, "p_partkey % 2 = 0"), ids("S", 6, "p_partkey % 3 = 0"), ids("T", 6, "p_partkey % 6 = 0"), ids("F", 65, "p_partkey % 7 = 0")):
        id_map = id_map.union(x)

    def acct(prefix, kind, where, current=1):
        return c.where(where).select(F.col("c_custkey").alias("account_no"), F.concat(F.lit(prefix), F.col("c_custkey").cast("string")).alias("external_id"),
                                     F.lit(kind).alias("external_id_type"), F.lit(current).alias("is_current"))

    params = F.array(*map(F.lit, ("29", "28", "166", "165", "164", "9")))
    return {
        "product": li.select(
            *track, F.col("l_partkey").alias("parent_subscr_no"), (F.col("l_partkey") % 2).alias("parent_subscr_no_resets"), F.col("l_suppkey").alias("parent_account_no"),
            F.col("l_linenumber").alias("component_id"), line, F.col("l_shipdate").alias("product_active_dt"),
            F.when(F.col("l_linestatus") == "F", F.date_add("l_shipdate", 30)).alias("product_inactive_dt"), F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("billing_inactive_dt"),
            (F.col("l_discount") == 0).alias("no_bill"), F.when(F.col("l_tax") > 0.04, F.concat(F.lit("M"), (F.col("l_linenumber") % 3).cast("string"))).alias("bill_period")),
        "id_map": id_map,
        "service": p.where("p_size % 10 <> 0").select(*sub, F.col("p_partkey").alias("view_id"), F.col("p_size").alias("emf_config_id"), (F.col("p_size") % 3 == 0).alias("no_bill"), F.col("p_brand").alias("chg_who")),
        "config_values": p.where("p_size < 45").select(F.col("p_size").alias("emf_config_id"), F.lit(1).alias("language_code"), F.concat(F.lit("Config "), F.col("p_size").cast("string")).alias("display_value")).distinct(),
        "account": c.select(F.col("c_custkey").alias("account_no"), F.col("c_nationkey").alias("account_type"), F.col("c_mktsegment").alias("bill_company"), (F.col("c_nationkey") % 7).alias("currency_code"),
                            (F.col("c_acctbal") < 0).alias("no_bill"), F.concat(F.lit("M"), (F.col("c_custkey") % 7).cast("string")).alias("bill_period")),
        "acct_map": acct("B", 1, "c_custkey % 11 <> 0").union(acct("BB", 1, "c_custkey % 13 = 0")).union(acct("I", 150, "c_custkey % 17 <> 0")),
        "customer_map": acct("O", 80, "c_custkey % 2 = 0").union(acct("X", 80, "c_custkey % 3 = 0", 0)),
        "component_element": li.where("l_linenumber <= 5").select(
            F.col("l_orderkey").alias("association_id"), F.col("l_linenumber").alias("association_id_serv"), F.when(F.col("l_partkey") % 4 == 0, 2).otherwise(1).alias("association_type"),
            F.col("l_orderkey").alias("component_inst_id"), F.col("l_linenumber").alias("component_inst_id_serv")),
        "package_component": li.where("l_linenumber <= 3").select(F.col("l_orderkey").alias("component_inst_id"), F.col("l_linenumber").alias("component_inst_id_serv"), (F.col("l_suppkey") % 30).alias("package_id")),
        "package_values": n.select(F.col("n_nationkey").alias("package_id"), F.when(F.col("n_nationkey") % 4 == 0, 2).otherwise(1).alias("language_code"), F.concat(F.lit("Package "), "n_name").alias("display_value")),
        "component_values": n.where("n_nationkey < 6").select(F.col("n_nationkey").alias("component_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("language_code"), F.col("n_name").alias("display_value")),
        "product_key": li.where("l_quantity > 10").select(*track, F.col("l_shipdate").alias("create_dt")),
        "rate_override": li.where("l_linenumber % 2 = 0").select(*track, F.round(F.col("l_extendedprice") * 100).cast("long").alias("override_rate"), F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")).alias("inactive_dt")),
        "bill_periods": r.select(F.concat(F.lit("M"), F.col("r_regionkey").cast("string")).alias("bill_period"), F.concat(F.lit("Period "), "r_name").alias("display_value")),
        "currency": r.select(F.col("r_regionkey").alias("currency_code"), F.lit(1).alias("language_code"), F.concat(F.lit("Currency "), "r_name").alias("display_value")),
        "product_attr": li.select(line, F.get(params, F.col("l_linenumber") % 6).alias("param_id"), F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("param_value")),
        "service_attr": p.where("p_size % 2 = 0").select(F.col("p_partkey").alias("view_id"), F.lit("107").alias("param_id"), F.concat(F.lit("CKT"), F.col("p_partkey").cast("string")).alias("param_value")),
    }


def q_billing_star(spark, d):
    """The billing pull with all its relations, reduced by key sets before it is joined."""
    from reckon.plans.pulls import billing_pull
    from reckon.session import cut_lineage

    keys = _t(spark, d, "part").where("p_size < 30").select(F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("C")).otherwise(F.lit("P")), F.col("p_partkey").cast("string")).alias("serv_comp_id"))
    return billing_pull(billing_tables(spark, d), keys, "serv_comp_id", cut_lineage)


def order_tables(spark, d) -> dict[str, DataFrame]:
    """The relations of the order pull: orders, services = line items, codes = nations."""
    li, o, n = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "nation")
    service_no = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("service_no")
    kinds = F.array(*map(F.lit, ("24256", "85454", "1", "21701", "105652")))
    return {
        "order": o.select(
            F.col("o_orderkey").alias("order_no"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"), F.concat(F.lit("CO"), F.col("o_custkey").cast("string")).alias("customer_order_id"),
            F.col("o_orderdate").alias("created_date"), F.when(F.col("o_orderstatus") != "P", F.date_add("o_orderdate", 7)).alias("last_updated_date"),
            (F.col("o_custkey") % 5).alias("order_action_id"), (F.col("o_custkey") % 40).alias("order_type_id"), F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4).alias("order_status_id")),
        "service": li.select(service_no, F.col("l_orderkey").alias("order_no"), F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("service_id"), F.col("l_shipdate").alias("bill_start_date"),
                             F.col("l_linenumber").alias("provisioning_status_id"), (F.col("l_suppkey") % 9).alias("service_action_id"), F.when(F.col("l_partkey") % 6 != 0, F.col("l_partkey") % 6).alias("service_status_id")),
        "alternate_id": li.where("l_quantity > 25").select(service_no, F.get(kinds, F.col("l_linenumber") % 5).alias("kind_id"), F.concat(F.lit("ALT"), F.col("l_partkey").cast("string")).alias("value")),
        "note": li.where("l_discount > 0.07").select(service_no, F.concat(F.lit("note "), F.col("l_suppkey").cast("string")).alias("note_text")),
        "order_lookup": n.select(F.col("n_nationkey").alias("lookup_id"), F.col("n_name").alias("lookup_value")),
    }


def q_ses_star(spark, d):
    """The order pull with six roles of one lookup table, alternate ids and notes."""
    from reckon.plans.pulls import order_pull
    from reckon.session import cut_lineage

    keys = _t(spark, d, "part").where("p_size < 20").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("serv_comp_id"))
    return order_pull(order_tables(spark, d), keys, "serv_comp_id", cut_lineage)


def account_tables(spark, d) -> dict[str, DataFrame]:
    """The relations of the account pull: groups and components = line items, accounts = orders, elements = parts."""
    li, o, p = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "part")
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    account, place = F.col("l_orderkey").alias("product_account_id"), F.col("l_linenumber").alias("occurrence_number")
    of = F.col("o_orderkey").alias("product_account_id")

    def element(prefix, where):
        return p.where(where).select(F.concat(F.lit("G"), (F.col("p_size") % 7 + 1).cast("string")).alias("component_group_cd"), F.col("p_partkey").cast("string").alias("component_grp_val"),
                                     F.concat(F.lit(prefix), F.col("p_partkey").cast("string")).alias("service_element_id"))

    return {
        "acct_group": li.select(account, place, F.concat(F.lit("K"), F.col("l_partkey").cast("string")).alias("common_ckt"), F.concat(F.lit("G"), F.col("l_linenumber").cast("string")).alias("component_group_cd"),
                                F.col("l_partkey").cast("string").alias("component_grp_val"), (F.col("l_suppkey") % 8).alias("application_code")),
        "contract": o.where("o_orderstatus <> 'P'").select(of, F.col("o_orderdate").alias("contract_date"), (F.col("o_custkey") % 60).alias("term_length"), F.when(F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 365)).alias("termination_date")),
        "service_element": element("E", "p_size % 3 = 0").union(element("EE", "p_size % 2 = 0")),
        "acct_component": li.where("l_quantity > 5").select(
            account, place, (F.col("l_suppkey") % 40).alias("prcmp_code"), F.when(F.col("l_tax") == 0, F.col("l_shipdate")).alias("prcmp_override_dt"), F.when(F.col("l_discount") > 0.08, F.col("l_shipdate")).alias("promotion_bgn_date"),
            F.when(F.col("l_discount") > 0.08, F.date_add("l_shipdate", 90)).alias("promotion_end_date"), F.col("l_shipdate").alias("bill_eff_bgn_date"), F.when(F.col("l_returnflag") == "A", F.col("l_shipdate")).alias("bill_eff_end_date"),
            F.date_add("l_shipdate", 30).alias("billed_thru_date"), F.col("l_extendedprice").alias("monthly_rev_est")),
        "product_acct": o.where("o_custkey % 10 <> 0").select(of, F.col("o_custkey").alias("customer_acct_id"), F.concat(F.lit("PC"), (F.col("o_custkey") % 7).cast("string")).alias("product_code")),
        "application": r.select(F.col("r_regionkey").alias("application_code"), F.concat(F.lit("Application "), "r_name").alias("application_cd_dsc")),
        "component_def": n.select(F.col("n_nationkey").alias("prcmp_code"), (F.col("n_nationkey") * 100).alias("prcmp_id"), F.col("n_name").alias("prcmp_dsc"), (F.col("n_regionkey") == 1).alias("billable_ind")),
        "component_group": n.where("n_nationkey between 1 and 5").select(F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("component_group_cd"), F.concat(F.lit("Group "), "n_name").alias("cmp_group_code_dsc")),
    }


def q_account_star(spark, d):
    """The account pull with all relations that give a row or a column."""
    from reckon.plans.pulls import account_pull
    from reckon.session import cut_lineage

    keys = _t(spark, d, "part").where("p_size < 25").select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("product_inst_id"))
    return account_pull(account_tables(spark, d), keys, "product_inst_id", cut_lineage)


def invoice_tables(spark, d) -> dict[str, DataFrame]:
    """The relations of the invoice pull: invoices = orders, lines = line items, services = parts, and those of the billing pull."""
    li, o, p = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "part")
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    same = billing_tables(spark, d)
    return {x: same[x] for x in ("account", "acct_map", "customer_map", "package_values", "id_map")} | {
        "invoice": o.select(F.col("o_custkey").alias("account_no"), F.col("o_orderkey").alias("bill_ref_no"), F.col("o_orderdate").alias("prep_date"), F.date_add("o_orderdate", 5).alias("statement_date"),
                            F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 4).alias("prep_status")),
        "invoice_detail": li.select(
            F.col("l_orderkey").alias("bill_ref_no"), F.col("l_partkey").alias("subscr_no"), (F.col("l_partkey") % 2).alias("subscr_no_resets"), (F.col("l_linenumber") % 2).alias("billing_level"), F.col("l_shipdate").alias("from_date"),
            F.date_add("l_shipdate", 30).alias("to_date"), F.when(F.col("l_suppkey") % 20 == 0, 1111).when(F.col("l_suppkey") % 20 != 1, F.col("l_suppkey") % 30).alias("package_id"), F.col("l_linenumber").alias("description_code"),
            (F.col("l_suppkey") % 7).alias("rate_currency_code"), ((F.col("l_partkey") % 50 + 1) * 100).alias("amount"), (F.col("l_linenumber") % 6).alias("type_code"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("annotation"),
            F.col("l_discount").alias("discount"), F.when(F.col("l_discount") > 0, F.col("l_suppkey")).alias("discount_id"), (F.col("l_linenumber") - 2).alias("subtype_code")),
        "currency": r.select(F.col("r_regionkey").alias("currency_code"), F.lit(1).alias("language_code"), F.substring("r_name", 1, 3).alias("short_display")),
        "descriptions": n.where("n_nationkey < 6").select(F.col("n_nationkey").alias("description_code"), F.lit(1).alias("language_code"), F.col("n_name").alias("description_text")),
        "service": p.where("p_size % 10 <> 0").select(F.col("p_partkey").alias("subscr_no"), (F.col("p_partkey") % 2).alias("subscr_no_resets"), F.col("p_partkey").alias("view_id")),
        "service_attr": p.select(F.col("p_partkey").alias("view_id"), F.when(F.col("p_size") % 4 != 0, "742").otherwise("107").alias("param_id"), F.concat(F.lit("pk"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("param_value")),
    }


INVOICE_SINCE = _dt.date(1997, 5, 1)


def q_invoice_lines(spark, d):
    """The invoice pull, for the invoice accounts of every third customer."""
    from reckon.plans.pulls import invoice_pull
    from reckon.session import cut_lineage

    bans = _t(spark, d, "customer").where("c_nationkey % 3 = 0").select(F.concat(F.lit("I"), F.col("c_custkey").cast("string")).alias("inv_ban"))
    return invoice_pull(invoice_tables(spark, d), bans, "inv_ban", INVOICE_SINCE, cut_lineage)


def q_package_status(spark, d):
    """Package lines with their status: the package pull, the invoice pull for the accounts of its open differences, the sums, the rules."""
    from reckon.plans.cycle_prep import Statuses, package_status
    from reckon.plans.pulls import invoice_pull, invoice_sums, package_pull
    from reckon.session import cut_lineage

    o, p = _t(spark, d, "orders"), _t(spark, d, "part")
    instance = F.concat(F.lit("PK-"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("product_inst_id")
    header = o.select(
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("piid_meid"), instance, F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("bill_acct_nbr"), F.concat(F.lit("I"), F.col("o_custkey").cast("string")).alias("inv_ban"),
        F.when(F.col("o_orderstatus") == "O", "In Progress").when(F.col("o_orderstatus") == "F", "Reversal").otherwise("Complete").alias("workflowstatus"),
        (F.col("o_custkey") % 50 + 1).cast("double").alias("piid_current_rate"), (F.col("o_orderkey") % 50).cast("double").alias("piid_new_rate"))
    active = p.select(F.lit("pk").alias("component_group_cd"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("component_grp_val"), F.col("p_size").cast("double").alias("monthly_rev_est"), F.col("p_name").alias("pkg_dsc"))
    packages = o.where("o_orderpriority <> '5-LOW'").select(F.substr(instance, F.lit(4)).alias("pkg_cgv"), F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("rr_piid_meid"))
    pkg = cut_lineage(package_pull(active, header, packages, "pkg_cgv", "rr_piid_meid"))
    bans = pkg.where("workflowstatus = 'In Progress' and diff <> 0").select("inv_ban")
    sums = invoice_sums(invoice_pull(invoice_tables(spark, d), bans, "inv_ban", INVOICE_SINCE, cut_lineage))
    return package_status(pkg, sums, Statuses())[1].select("piid_meid", "component_grp_val", "scid", "inv_ban", "workflowstatus", "pkg_dsc", "monthly_rev_est", "piid_current_rate", "piid_new_rate", "diff", "pkg_status")


def q_primary_terms(spark, d):
    """The latest term of each instance's circuits: circuits joined to components, components to rows."""
    from reckon.plans.pulls import term_pull

    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    parts = li.where("l_returnflag <> 'N'").select(name("S", "l_partkey").alias("circuit_scid"), name("P", "l_suppkey").alias("circuit_piid"))
    circuits = o.where("o_orderstatus <> 'P'").select(name("P", "o_custkey").alias("product_inst_id"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderdate")).alias("term_end_date"))
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(name("S", "l_partkey").alias("serv_comp_id"), name("I", "o_custkey").alias("product_inst_id"))
    return term_pull(parts, circuits, rows)


def cycle_pull_tables(spark, d) -> dict[str, DataFrame]:
    """The cycle preparation's inputs without any pre-joined one: rows, guide and products as in
    ``cycle_inputs``; billing, accounts, orders, invoices and terms as the relations of their pulls."""
    from reckon.session import cut_lineage

    li, o, s = _t(spark, d, "lineitem"), _t(spark, d, "orders"), _t(spark, d, "supplier")
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    code = F.when(F.col("l_linenumber") == 7, 1).when(F.col("l_linenumber") % 3 == 0, 2).otherwise(0)  # kind of component, as in cycle_inputs
    cid, grp = F.get(F.array(*map(F.lit, ("CI", "pk", "X-"))), code), F.lpad(F.col("l_partkey").cast("string"), 8, "0")
    lx = li.select("*", cid.alias("cid"), grp.alias("grp"), F.concat(cid, grp).alias("scid"), (F.col("l_partkey") * 3 + code).alias("subscr_no"))
    none = F.lit(None)
    sub, zero = F.col("subscr_no"), F.lit(0).alias("subscr_no_resets")
    track = [F.col("l_orderkey").alias("tracking_id"), F.col("l_linenumber").alias("tracking_id_serv")]
    subs = cut_lineage(lx.select(sub, "scid").distinct())  # read by three relations
    accounts = s.select(F.col("s_suppkey").alias("account_no"))
    ban = lambda kind, prefix, at: at.select("account_no", text(prefix, "account_no").alias("external_id"), F.lit(kind).alias("external_id_type"))
    shown = billing_tables(spark, d)
    customers = _t(spark, d, "customer").select(F.col("c_custkey").alias("account_no"))
    billed = lx.where("l_returnflag = 'R'")
    rows = cycle_inputs(spark, d)
    keep = ("rate_detail", "rate_header", "billed_records", "active_products", "quantity_guide", "term_fallback")
    billing = {
        "product": billed.select(
            *track, sub.alias("parent_subscr_no"), F.lit(0).alias("parent_subscr_no_resets"), F.col("l_suppkey").alias("parent_account_no"), F.lit(1).alias("component_id"), F.col("l_partkey").alias("view_id"),
            F.col("l_shipdate").alias("product_active_dt"), F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("product_inactive_dt"), none.cast("timestamp_ntz").alias("billing_inactive_dt"),
            F.lit(False).alias("no_bill"), F.lit("M1").alias("bill_period")),
        "id_map": subs.select(sub, zero, F.col("scid").alias("external_id"), F.lit(1).alias("external_id_type"), none.cast("timestamp_ntz").alias("inactive_date")),
        "service": subs.select(sub, zero, sub.alias("view_id"), F.lit(1).alias("emf_config_id"), F.lit(False).alias("no_bill"), F.lit("x").alias("chg_who")),
        "account": accounts.union(customers).distinct().select("account_no", F.lit(1).alias("account_type"), F.lit("C").alias("bill_company"), F.lit(1).alias("currency_code"), F.lit(False).alias("no_bill"), F.lit("M2").alias("bill_period")),
        "acct_map": ban(1, "B", accounts).union(ban(150, "I", accounts.union(customers).distinct())),
        "customer_map": ban(80, "O", accounts).withColumn("is_current", F.lit(1)),
        "config_values": _t(spark, d, "region").where("r_regionkey = 1").select(F.col("r_regionkey").alias("emf_config_id"), F.lit(1).alias("language_code"), F.col("r_name").alias("display_value")),
        "component_values": shown["component_values"], "bill_periods": shown["bill_periods"], "package_values": shown["package_values"],
        "component_element": li.select(F.col("l_orderkey").alias("association_id"), F.col("l_linenumber").alias("association_id_serv"), F.lit(1).alias("association_type"), F.col("l_orderkey").alias("component_inst_id"), F.col("l_linenumber").alias("component_inst_id_serv")),
        "package_component": shown["package_component"], "product_key": shown["product_key"], "product_attr": shown["product_attr"],
        "rate_override": billed.where("l_linenumber <> 4").select(*track, F.round((F.col("l_discount") + 0.01) * 100).cast("long").alias("override_rate"), none.cast("timestamp_ntz").alias("inactive_dt")),
        "currency": shown["currency"].withColumn("short_display", F.col("display_value")),
        # 742: the package that the invoice lines of a service belong to
        "service_attr": subs.select(sub.alias("view_id"), F.lit("742").alias("param_id"), F.col("scid").alias("param_value")),
    }
    lo = lx.join(rows["rate_header"].select("piid_meid", "product_inst_id"), F.col("l_orderkey").cast("string") == F.col("piid_meid"))
    account = account_tables(spark, d) | {
        "acct_group": lo.select(F.col("l_orderkey").alias("product_account_id"), F.col("l_linenumber").alias("occurrence_number"), F.col("product_inst_id").alias("common_ckt"), F.col("cid").alias("component_group_cd"),
                                F.col("grp").alias("component_grp_val"), F.lit(1).alias("application_code")),
        "acct_component": lx.where("l_returnflag <> 'N'").select(
            F.col("l_orderkey").alias("product_account_id"), F.col("l_linenumber").alias("occurrence_number"), F.col("l_suppkey").cast("string").alias("prcmp_code"), *[none.cast("timestamp_ntz").alias(c) for c in ("prcmp_override_dt", "promotion_bgn_date", "promotion_end_date", "billed_thru_date")],
            F.col("l_shipdate").alias("bill_eff_bgn_date"), F.when(F.col("l_quantity") > 45, F.col("l_shipdate")).alias("bill_eff_end_date"), F.col("l_discount").alias("monthly_rev_est")),
        "component_def": s.select(F.col("s_suppkey").cast("string").alias("prcmp_code"), F.col("s_suppkey").alias("prcmp_id"), text("S", "s_suppkey").alias("prcmp_dsc"), F.lit("Y").alias("billable_ind")),
        "service_element": cut_lineage(lx.where("l_partkey % 2 = 0").select(F.col("cid").alias("component_group_cd"), F.col("grp").alias("component_grp_val"), text("SEX", "l_partkey").alias("service_element_id")).distinct()),  # read by both account pulls
    }
    order = order_tables(spark, d)
    disconnect = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    order |= {
        "order_service": lx.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("service_no"), F.col("l_orderkey").alias("order_no"), F.col("scid").alias("service_id"), F.col("l_shipdate").alias("bill_start_date"),
                                   F.lit(2).alias("provisioning_status_id"), F.when(disconnect, 1).otherwise(2).alias("service_action_id"), F.lit(2).alias("service_status_id")),
        "order_lookup": _t(spark, d, "nation").select(F.col("n_nationkey").alias("lookup_id"), F.when(F.col("n_nationkey") == 1, "Disconnect").otherwise("Change").alias("lookup_value")),
    }
    invoice = invoice_tables(spark, d)
    invoice = {x: invoice[x] for x in ("invoice", "descriptions")} | {"invoice_detail": invoice["invoice_detail"].withColumns({"subscr_no": F.col("subscr_no") * 3, "subscr_no_resets": F.lit(0)})}
    terms = {
        "circuit_component": billed.select(F.col("scid").alias("circuit_scid"), text("T", "l_orderkey").alias("circuit_piid")),
        "circuit": o.select(text("T", "o_orderkey").alias("product_inst_id"), F.add_months("o_orderdate", 12).cast("timestamp_ntz").alias("term_end_date")),
    }
    del order["service"]
    return {x: rows[x] for x in keep} | account | billing | order | invoice | terms


def q_cycle_prep_pulls(spark, d):
    """J3 through the job API with every pull made by the job itself: billing, accounts (twice), orders, invoices and terms."""
    from reckon.plans.cycle_prep import cycle_prep

    return cycle_prep(cycle_pull_tables(spark, d), 1997, 6, 31)["rr_scid"].select(*CYCLE_OUT)


# ---------------------------------------------------------------- sources / sinks


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (local scratch
    only when a local session names none, as in tests)."""
    import uuid

    from reckon.session import shared_dir

    return f"{shared_dir(spark).rstrip('/')}/reckon-out/{name}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, d):
    from reckon.sources.csv_ingest import ingest_csv

    o = _t(spark, d, "orders")
    src = _scratch(spark, "csv-src")
    o.write.mode("overwrite").option("header", True).csv(src)
    return ingest_csv(spark, f"{src}/*.csv", _scratch(spark, "csv-table"), schema=o.schema, check_header=True)


def q_ledger_ingest(spark, d):
    """Two drops of orders: the second run takes the new file alone, a third one nothing; lines that
    do not fit the schema are set aside."""
    from reckon.sources.ledger import ingest_files, read_quarantine, read_rows

    o = _t(spark, d, "orders")
    src, target = _scratch(spark, "drops"), _scratch(spark, "ledger")
    # a status that is no number is malformed for the schema of the drop
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_code", T.IntegerType())])
    code = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.substring("o_orderpriority", 1, 1))
    for k in range(2):
        o.where(F.col("o_orderkey") % 2 == k).select("o_orderkey", code.alias("o_code")).write.option("header", True).csv(f"{src}/drop{k}")
        ingest_files(spark, f"{src}/*/*.csv", target, schema)
    ingest_files(spark, f"{src}/*/*.csv", target, schema)
    good = read_rows(spark, target, schema).select("o_orderkey", "o_code", F.lit("row").alias("kind"))
    bad = read_quarantine(spark, target).select(F.split("line", ",")[0].cast("long").alias("o_orderkey"), F.lit(None).cast("int").alias("o_code"), F.lit("quarantine").alias("kind"))
    return good.unionByName(bad)


def q_sink_roundtrip(spark, d):
    from reckon.sources.sink import read_output, write_outputs

    base = _scratch(spark, "outputs")
    outs = {"tstage": q_agg_sum_by_month(spark, d), "flags": q_any_match_group(spark, d)}
    write_outputs(outs, base, "2025-06")
    read = {name: read_output(spark, base, name, "2025-06").withColumn("output", F.lit(name)) for name in outs}
    return read["tstage"].unionByName(read["flags"], allowMissingColumns=True)


def q_bucketed_join(spark, d):
    """Detail and header as named tables bucketed by the order: their join needs no exchange."""
    import uuid

    from reckon.sources.catalog import Catalog, save_bucketed

    run = uuid.uuid4().hex
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    specs = {
        "detail": save_bucketed(li, f"reckon_detail_{run}", ["l_orderkey"], n, _scratch(spark, "detail")),
        "header": save_bucketed(o, f"reckon_header_{run}", ["o_orderkey"], n, _scratch(spark, "header")),
    }
    cat = Catalog(spark, specs)
    joined = cat.table("detail").join(cat.table("header").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_custkey", "o_orderstatus")


def q_ci_pushdown(spark, d):
    """Parts with lower-cased companions written at ingest; case-insensitive filters that reach the scan."""
    path = _scratch(spark, "ci")
    with_ci(_t(spark, d, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "p_brand").write.parquet(path)
    return drop_ci(ci_where(ci_where(spark.read.parquet(path), "p_brand", not_equals="BRAND#11"), "p_name", starts="SMALL"))


def q_snapshot_newest(spark, d):
    """Monthly snapshots of orders as one partitioned table; its newest snapshot without a scan for the maximum."""
    path = _scratch(spark, "snapshots")
    write_snapshot(_t(spark, d, "orders").withColumn("snapshot", yyyymm("o_orderdate")), path)
    return newest_snapshot(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "snapshot")


def q_rule_counts(spark, d):
    """Counts per label, observed while the classification's result is written: no pass of their own."""
    from reckon.plans.classify import Labels

    labels = list(vars(Labels()).values())
    out, seen = observe_labels(q_classify_job(spark, d), "nonactionable_reason", labels)
    out.write.parquet(_scratch(spark, "classified"))
    got = seen.get
    return spark.createDataFrame([(x, got[x]) for x in ["rows", "unlabelled", "other", *labels]], "label string, n long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
