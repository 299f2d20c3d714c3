import datetime as dt


from helpers import rows
from reckon.operators.compare import latest_snapshot, period_compare, sum_by_month
from reckon.operators.pivot import pivot_attributes, pivot_typed_ids, role_dims


def test_pivot_attributes(spark):
    df = spark.createDataFrame([(1, "166", "desc"), (1, "165", "code"), (2, "166", "d2"), (2, "999", "x")], "view int, p string, v string")
    out = pivot_attributes(df, "view", "p", "v", {"166": "prcmp_desc", "165": "prcmp_code", "164": "prcmp_id"})
    assert rows(out) == [(1, "desc", "code", None), (2, "d2", None, None)]


def test_pivot_typed_ids(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(1, 1, "A", t0), (1, 1, "B", t1), (1, 6, "S", t0), (2, 5, "P", t0)], "sub int, typ int, ext string, ts timestamp")
    out = pivot_typed_ids(df, "sub", "typ", "ext", {1: "t1", 5: "t5", 6: "t6"}, order_col="ts")
    assert rows(out) == [(1, "B", None, "S"), (2, None, "P", None)]


def test_role_dims(spark):
    dim = spark.createDataFrame([(1, "Open"), (2, "Disconnect")], "id int, value string")
    df = spark.createDataFrame([(10, 1, 2), (11, 2, None)], "o int, st int, act int")
    out = role_dims(df, dim, "id", {"status": "st", "action": "act"}, ["value"], bounded=True)
    assert rows(out, "o", "status_value", "action_value") == [(10, "Open", "Disconnect"), (11, "Disconnect", None)]


def test_latest_snapshot_and_month_sum(spark):
    f1, f2 = dt.datetime(2025, 5, 28), dt.datetime(2025, 6, 28)
    df = spark.createDataFrame(
        [("i", "r", dt.datetime(2025, 1, 5), 1.10, f1), ("i", "r", dt.datetime(2025, 1, 9), 2.20, f2), ("i", "r", dt.datetime(2025, 1, 20), 0.10, f2),
         ("i", "r", dt.datetime(2024, 1, 9), 5.0, f2)],
        "initiative string, rerate_type string, rerate_month timestamp, increase double, finalized_date timestamp",
    )
    snap = latest_snapshot(df, "finalized_date")
    assert snap.count() == 3
    g = sum_by_month(snap, ["initiative", "rerate_type"], "rerate_month", "increase", 2025, month_col="m").collect()
    assert len(g) == 1 and float(g[0].sum_increase) == 2.30 and g[0].m == 1


def test_period_compare(spark):
    prev = spark.createDataFrame([("a", None, 1, 100.0), ("b", "x", 1, 0.0), ("c", "x", 2, 100.0), ("d", "x", 3, 100.0)],
                                 "k1 string, k2 string, m int, v double")
    curr = spark.createDataFrame([("a", None, 1, 121.0), ("b", "x", 1, 5.0), ("d", "x", 3, 79.0), ("new", "x", 1, 9.0)],
                                 "k1 string, k2 string, m int, v double")
    out = period_compare(prev, curr, ["k1", "k2", "m"], "v")
    got = {r.k1: (r.curr_value, r.percent_diff, r.over_hi, r.under_lo) for r in out.collect()}
    assert got["a"] == (121.0, 21.0, 1, 0)  # null key part matches null
    assert got["b"] == (5.0, None, None, None)  # base 0
    assert got["c"] == (None, None, None, None)  # missing current
    assert got["d"][2:] == (0, 1)
    assert "new" not in got  # rows only in the current month are dropped


def test_compare_periods_one_pass_matches_join_version(spark):
    from reckon.operators.compare import compare_periods

    rows_ = [("a", None, 1996, 100.0), ("a", None, 1997, 121.0), ("b", "x", 1996, 0.0), ("b", "x", 1997, 5.0), ("c", "x", 1996, 100.0),
             ("d", "x", 1996, 60.0), ("d", "x", 1996, 40.0), ("d", "x", 1997, 79.0), ("new", "x", 1997, 9.0), ("z", "x", 1995, 1.0)]
    df = spark.createDataFrame(rows_, "k1 string, k2 string, y int, v double")
    one = compare_periods(df, ["k1", "k2"], "y", 1996, 1997, "v")
    p = df.where("y = 1996").groupBy("k1", "k2").agg({"v": "sum"}).withColumnRenamed("sum(v)", "v")
    c = df.where("y = 1997").groupBy("k1", "k2").agg({"v": "sum"}).withColumnRenamed("sum(v)", "v")
    two = period_compare(p, c, ["k1", "k2"], "v")
    assert rows(one) == rows(two)
    got = {r.k1: (r.prev_value, r.curr_value, r.percent_diff, r.over_hi, r.under_lo) for r in one.collect()}
    assert got["a"] == (100.0, 121.0, 21.0, 1, 0)
    assert got["b"][2:] == (None, None, None)
    assert got["c"] == (100.0, None, None, None, None)
    assert got["d"] == (100.0, 79.0, -21.0, 0, 1)
    assert "new" not in got and "z" not in got
