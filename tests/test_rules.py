import random

from pyspark.sql import functions as F

from helpers import plan_text, rows
from reckon.operators.rules import Case, Rule, Stage, case_map, group_category, staged_status, waterfall


def _rules():
    return [
        Rule("neg", "N", F.col("a") < 0),
        Rule("both", "A", (F.col("b") == "x") & (F.col("a") > 5)),  # specific before general
        Rule("x", "N", F.col("b") == "x"),
        Rule("big", "P", F.col("a") > 8),
    ]


def _model(a, b):
    """Row-at-a-time reference model of the same rule list (tests only)."""
    if a is not None and a < 0:
        return ("neg", "N")
    if b == "x" and a is not None and a > 5:
        return ("both", "A")
    if b == "x":
        return ("x", "N")
    if a is not None and a > 8:
        return ("big", "P")
    return ("ok", "A")


def test_waterfall_first_match_and_null(spark):
    df = spark.createDataFrame([(1, -1, "x"), (2, 6, "x"), (3, 1, "x"), (4, 9, "y"), (5, None, None), (6, 2, "y")], "id int, a int, b string")
    out = waterfall(df, _rules(), ("ok", "A"))
    assert rows(out, "id", "reason", "category") == [
        (1, "neg", "N"), (2, "both", "A"), (3, "x", "N"), (4, "big", "P"), (5, "ok", "A"), (6, "ok", "A")]


def test_waterfall_differential_random(spark):
    rnd = random.Random(42)
    data = [(i, rnd.choice([None, -3, 0, 4, 6, 9, 12]), rnd.choice([None, "x", "y", ""])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, a int, b string")
    got = {r.id: (r.reason, r.category) for r in waterfall(df, _rules(), ("ok", "A")).collect()}
    assert got == {i: _model(a, b) for i, a, b in data}


def test_waterfall_keeps_existing_label(spark):
    df = spark.createDataFrame([(1, -1, "x", "pre", "C"), (2, -1, "x", None, None), (3, -1, "x", "", None)],
                               "id int, a int, b string, reason string, category string")
    out = waterfall(df, _rules(), ("ok", "A"), keep_existing=True)
    assert rows(out, "id", "reason", "category") == [(1, "pre", "C"), (2, "neg", "N"), (3, "neg", "N")]


def test_staged_status(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, 0, 0)], "id int, p int, q int")
    out = staged_status(df, "status", [
        Stage("fill", F.col("p") == 1, "P"),
        Stage("fill", F.col("q") == 1, "Q"),
        Stage("overwrite", (F.col("p") == 1) & (F.col("q") == 1), "PQ"),
        Stage("fill", F.lit(None).cast("boolean"), "never"),
    ])
    assert rows(out, "id", "status") == [(1, "P"), (2, "Q"), (3, "PQ"), (4, None)]


def test_case_map_several_columns(spark):
    df = spark.createDataFrame([(1, "In Progress", "Disconnect"), (2, "In Progress", "Canceled due to Renewal"), (3, "Done", "Disconnect")],
                               "id int, wf string, disp string")
    ip = F.col("wf") == "In Progress"
    out = case_map(df, [
        Case(ip & (F.col("disp") == "Canceled due to Renewal"), {"s": "Canceled", "r": "Renewal", "n": "Renewal per validator"}),
        Case(ip & (F.col("disp") == "Disconnect"), {"s": "Canceled", "r": "Disconnect", "n": "Disconnect per validator"}),
    ], {"s": None, "r": None, "n": None})
    assert rows(out, "id", "s", "r", "n") == [
        (1, "Canceled", "Disconnect", "Disconnect per validator"), (2, "Canceled", "Renewal", "Renewal per validator"), (3, None, None, None)]


def test_group_category(spark):
    df = spark.createDataFrame([("p1", "Actionable"), ("p1", "NonActionable"), ("p2", "NonActionable")], "piid string, cat string")
    out = group_category(df, "piid", "cat", "Actionable", "any_act")
    assert rows(out, "piid", "cat", "any_act") == [("p1", "Actionable", True), ("p1", "NonActionable", True), ("p2", "NonActionable", False)]


def test_waterfall_is_one_projection(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))
    plan = plan_text(waterfall(df, _rules() * 10, ("ok", "A")))
    assert "Exchange" not in plan  # no shuffle, whatever the number of rules
