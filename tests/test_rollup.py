import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from reckon.operators.rollup import any_match, complete_group_max, dedupe_latest, first_per_group, latest_per_key, priority_rollup

LABELS = ["Always > 1", "Could be > 1 or = 1", "Always = 1"]


def test_priority_rollup(spark):
    df = spark.createDataFrame(
        [("g1", "Always = 1"), ("g1", "Could be > 1 or = 1"), ("g2", "Always = 1"), ("g3", None), ("g4", "Always > 1"),
         ("g4", "Always = 1"), (None, "Always > 1"), ("g5", "other")],
        "g string, q string",
    )
    got = dict(rows(priority_rollup(df, "g", "q", LABELS, "Always = 1", "gq")))
    assert got == {"g1": "Could be > 1 or = 1", "g2": "Always = 1", "g3": "Always = 1", "g4": "Always > 1", "g5": "Always = 1"}
    blank = dict(rows(priority_rollup(df, "g", "q", LABELS[:2], None, "gq")))
    assert blank["g2"] is None and blank["g4"] == "Always > 1"
    per_row = priority_rollup(df, "g", "q", LABELS, None, "gq", per_row=True)
    assert per_row.count() == df.count()
    win = priority_rollup(df, "g", "q", LABELS, None, "gq", per_row=True, via="window")
    assert rows(win, "g", "q", "gq") == rows(per_row, "g", "q", "gq")


def test_any_match(spark):
    df = spark.createDataFrame([("a", "Disconnect"), ("a", "Add"), ("b", None), ("c", "Add")], "k string, act string")
    assert dict(rows(any_match(df, "k", F.col("act") == "Disconnect", "d"))) == {"a": True, "b": False, "c": False}


def test_complete_group_max(spark):
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 3, 1)
    df = spark.createDataFrame(
        [("all", d1, True), ("all", d2, True), ("open", None, True), ("open", d1, True), ("miss", d2, True), ("miss", None, None),
         ("none", None, True), ("single", d1, True)],
        "g string, d timestamp, found boolean",
    )
    got = dict(rows(complete_group_max(df, "g", "d", F.col("found"), "m")))
    assert got == {"all": d2, "open": d1, "miss": None, "none": None, "single": d1}
    strict = dict(rows(complete_group_max(df, "g", "d", F.col("found"), "m", require_all=True)))
    assert strict["open"] is None and strict["all"] == d2


def test_latest_per_key_ties_kept(spark):
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    df = spark.createDataFrame(
        [("p", d2, "In Progress", 1), ("p", d2, "Complete", 2), ("p", d1, "Complete", 3), ("q", d2, "Canceled", 4), ("q", d1, "In Progress", 5)],
        "k string, d timestamp, s string, id int",
    )
    out = latest_per_key(df, "k", "d", where=F.col("s") != "Canceled")
    assert rows(out, "id") == [(1,), (2,), (5,)]


def test_first_per_group_nulls_first(spark):
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    df = spark.createDataFrame([("a", d1), ("a", None), ("a", d2), ("b", d1), ("b", d2), (None, d1)], "k string, d timestamp")
    assert rows(first_per_group(df, "k", ["d desc nulls first"])) == [("a", None), ("b", d2)]
    assert rows(first_per_group(df, "k", ["d desc nulls last"])) == [("a", d2), ("b", d2)]


def test_dedupe_latest_tie_by_key(spark):
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    df = spark.createDataFrame([("c", 3, d2), ("c", 1, d2), ("c", 2, d1), ("e", 9, None), ("e", 8, d1)], "k string, id int, d timestamp")
    assert rows(dedupe_latest(df, "k", "d", tie="id"), "k", "id") == [("c", 1), ("e", 8)]


def test_mixed_direction_order(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("a", 2, 9.0)], "k string, n int, v double")
    assert rows(first_per_group(df, "k", ["n asc", "v desc"]), "k", "n", "v") == [("a", 1, 7.0)]


def test_mixed_direction_on_timestamp_ntz(spark):
    import datetime as dt2

    df = spark.createDataFrame(
        [("a", 1, dt2.datetime(2024, 3, 10, 2, 30, 0, 5)), ("a", 1, dt2.datetime(2024, 3, 10, 3, 30)), ("a", 2, dt2.datetime(2030, 1, 1))],
        "k string, n int, t timestamp_ntz")
    # n asc, then t desc: among n = 1 the later wall-clock time wins, independent of any time zone
    assert rows(first_per_group(df, "k", ["n asc", "t desc"]), "k", "n", "t") == [("a", 1, dt2.datetime(2024, 3, 10, 3, 30))]
    df2 = df.withColumn("n", F.lit(1))
    assert rows(first_per_group(df2, "k", ["n asc", "t asc"]), "t") == [(dt2.datetime(2024, 3, 10, 2, 30, 0, 5),)]
