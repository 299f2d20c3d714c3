import datetime as dt

from pyspark.sql import functions as F

from reckon.functions.columns import (
    blank_to_null, ci_eq, ci_like, ci_ne, clamped_diff, concat_strict, contains_lit, is_blank, key_concat, ne_null_safe,
    pct_change, safe_date, safe_num, scale_by_decimals, threshold_flag,
)
from reckon.functions.dates import check_date, cycle_date, mdy, prev_month_abbr, prev_yyyymm, yyyymm


def test_blank_and_normalisation(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3), (" ", 4)], "s string, n int")
    assert [r.b for r in df.select(is_blank("s").alias("b")).orderBy("n").collect()] == [False, True, True, False]
    out = blank_to_null(df).orderBy("n").collect()
    assert [r.s for r in out] == ["a", None, None, " "]  # no trimming
    assert [r.n for r in out] == [1, 2, 3, 4]


def test_key_concat_blank_as_empty_and_collision(spark):
    df = spark.createDataFrame([("1", "12"), ("11", "2"), (None, "x"), ("a", None)], "a string, b string")
    got = [r.k for r in df.select(key_concat("a", "b").alias("k")).collect()]
    assert got == ["112", "112", "x", "a"]  # collision is the documented price of sep=''
    got = [r.k for r in df.select(key_concat("a", "b", sep="|").alias("k")).collect()]
    assert got[:2] == ["1|12", "11|2"]
    strict = [r.k for r in df.select(concat_strict("a", "b").alias("k")).collect()]
    assert strict == ["112", "112", None, None]


def test_case_insensitive_predicates(spark):
    df = spark.createDataFrame([("Canceled",), ("canceled",), ("Open",), (None,)], "s string")
    assert df.where(ci_eq("s", "CANCELED")).count() == 2
    assert df.where(ci_ne("s", "canceled")).count() == 1  # null dropped
    assert df.where(ne_null_safe("s", "Open")).count() == 3  # null kept
    assert df.where(ci_like("s", "can%")).count() == 2


def test_contains_literal_not_regex(spark):
    df = spark.createDataFrame([("ab**LCC",), ("x.y",), (None,), ("VANTIVE-1",)], "s string")
    r = df.select(
        contains_lit("s", "**lcc", ignore_case=True).alias("a"), contains_lit("s", ".").alias("b"),
        contains_lit("s", "vantive", ignore_case=True).alias("c"), contains_lit("s", "vantive").alias("d"),
    ).collect()
    assert [x.a for x in r] == [True, False, False, False]
    assert [x.b for x in r] == [False, True, False, False]
    assert [x.c for x in r] == [False, False, False, True]
    assert [x.d for x in r] == [False, False, False, False]


def test_clamped_diff_edges(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 10.0), (2, 10.005, 10.0), (3, 10.01, 10.0), (4, 9.0, 10.0), (5, None, 1.0), (6, 12.5, 10.0)],
        "i int, a double, b double",
    )
    d = {r.i: r.d for r in df.select("i", clamped_diff(F.col("a").cast("decimal(18,3)"), F.col("b").cast("decimal(18,3)")).alias("d")).collect()}
    assert d[1] == 0 and d[2] == 0 and d[4] == 0  # below tolerance and negatives clamp to 0
    assert abs(d[3] - 0.01) < 1e-12  # exactly the tolerance is kept
    assert d[5] is None
    assert abs(d[6] - 2.5) < 1e-12


def test_pct_change_and_flags(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 120.0), (2, 100.0, 80.0), (3, 0.0, 5.0), (4, 100.0, None), (5, -50.0, -100.0), (6, 100.0, 121.0), (7, None, 3.0)],
        "i int, old double, new double",
    )
    out = df.select("i", pct_change("new", "old").alias("p"))
    out = out.select("i", "p", threshold_flag("p", 20.0).alias("hi"), threshold_flag("p", -20.0, above=False).alias("lo"))
    r = {x.i: (x.p, x.hi, x.lo) for x in out.collect()}
    assert r[1] == (20.0, 0, 0)  # exactly +20 is not "over"
    assert r[2] == (-20.0, 0, 0)
    assert r[3] == (None, None, None)  # base 0
    assert r[4] == (None, None, None)
    assert r[5] == (100.0, 1, 0)  # negative base
    assert r[6][1] == 1
    assert r[7] == (None, None, None)


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("2024-01-31",), ("9999-12-31",), ("garbage",), ("",), (None,)], "s string")
    got = [r.d for r in df.select(safe_date("s", ns_range=True).alias("d")).collect()]
    assert got[0] == dt.datetime(2024, 1, 31)
    assert got[1:] == [None, None, None, None]  # beyond the nanosecond range counts as missing, where asked for
    assert [r.d for r in df.select(safe_date("s").alias("d")).collect()][1:] == [dt.datetime(9999, 12, 31), None, None, None]
    nums = spark.createDataFrame([("1.5",), ("",), ("x",), (None,)], "s string")
    assert [r.n for r in nums.select(safe_num("s").alias("n")).collect()] == [1.5, None, None, None]


def test_scale(spark):
    df = spark.createDataFrame([(12345, 2), (12345, 0), (5, 3)], "a long, d int")
    assert [r.x for r in df.select(scale_by_decimals("a", F.col("d")).alias("x")).collect()] == [123.45, 12345.0, 0.005]


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 15),), (dt.date(2025, 1, 31),), (dt.date(2024, 3, 1),)], "d date")
    r = df.select(
        check_date(F.col("d")).alias("chk"), prev_month_abbr(F.col("d")).alias("pm"), mdy("d").alias("m"),
        yyyymm(F.col("d")).alias("p"), prev_yyyymm(F.col("d")).alias("pp"),
    ).collect()
    assert [x.chk for x in r] == [dt.date(2026, 3, 1), dt.date(2025, 4, 1), dt.date(2024, 6, 1)]  # year carries
    assert [x.pm for x in r] == ["NOV", "DEC", "FEB"]  # January looks back to December
    assert [x.m for x in r] == ["12/15/2025", "01/31/2025", "03/01/2024"]
    assert [x.p for x in r] == [202512, 202501, 202403]
    assert [x.pp for x in r] == [202511, 202412, 202402]
    one = spark.range(1).select(cycle_date(2025, 6, 31).alias("a"), cycle_date(2024, 2, 30).alias("b"), cycle_date(2025, 6, 15).alias("c")).first()
    assert (one.a, one.b, one.c) == (dt.date(2025, 6, 30), dt.date(2024, 2, 29), dt.date(2025, 6, 15))


def test_case_insensitive_filters_reach_the_scan(spark, tmp_path):
    """Same rows with the companion, without it, and by ci_eq; the equality is pushed to the scan only with it."""
    from helpers import plan_text, rows
    from reckon.functions.columns import ci_eq, ci_ne, ci_where, drop_ci, with_ci

    df = spark.createDataFrame([("Small Ring", 1), ("SMALL", 2), ("small", 3), ("", 4), (None, 5), ("ÉTÉ", 6), ("été", 7)], "name string, v int")
    path = str(tmp_path / "t")
    with_ci(df, "name").write.parquet(path)
    t = spark.read.parquet(path)
    assert drop_ci(t).columns == ["name", "v"] and rows(drop_ci(t)) == rows(df)
    for given, plain in ((dict(equals="Small"), ci_eq("name", "Small")), (dict(equals="ÉTÉ"), ci_eq("name", "ÉTÉ")), (dict(not_equals="small"), ci_ne("name", "small")),
                         (dict(equals=["SMALL", ""]), F.lower("name").isin("small", "")), (dict(starts="sMa"), F.lower("name").startswith("sma"))):
        want = rows(df.where(plain))
        assert want and rows(drop_ci(ci_where(t, "name", **given))) == want == rows(ci_where(df, "name", **given)), given
    assert "EqualTo(name__ci,small)" in plan_text(ci_where(t, "name", equals="SMALL"))
    assert "StringStartsWith(name__ci,sma)" in plan_text(ci_where(t, "name", starts="SMA"))
    assert "EqualTo" not in plan_text(drop_ci(t).where(ci_eq("name", "small")))
