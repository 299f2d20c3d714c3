"""Reduced stars, roles decoded by one join, hot keys joined in place, label sets."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_text, rows
from reckon.operators.hot import hot_keys, hot_left_join
from reckon.operators.lookup import lookup, propagate_by_key
from reckon.operators.rollup import any_match, with_group_value
from reckon.operators.rules import group_category, group_labels
from reckon.operators.star import Dim, decode_roles, join_star, reduce_star, star
from reckon.plans.pulls import billing_pull, order_pull
from reckon.session import cut_lineage


@pytest.fixture(scope="module")
def snowflake(spark):
    rng = random.Random(3)
    pick = lambda n: rng.choice([None, *range(n)])
    root = spark.createDataFrame([(k, pick(12), pick(6), pick(9)) for k in range(200)], "id int, a int, b int, c int")
    tables = {
        "x": spark.createDataFrame([(pick(8), pick(5), f"x{k}") for k in range(14)], "a int, y int, v string"),
        "y": spark.createDataFrame([(k, f"y{k}") for k in range(4)], "y int, v string"),
        "z": spark.createDataFrame([(pick(6), pick(9), f"z{k}") for k in range(40)], "b int, c int, v string"),
    }
    return root, tables


@pytest.mark.parametrize("inner", range(8))
@pytest.mark.parametrize("cut", [None, cut_lineage])
def test_reduced_star_equals_plain_joins(snowflake, inner, cut):
    root, t = snowflake
    x, y, z = (bool(inner & b) for b in (1, 2, 4))
    dims = [Dim("x", t["x"], {"a": "a"}, {"v": "xv"}, inner=x), Dim("y", t["y"], {"y": "y"}, {"v": "yv"}, parent="x", inner=y, code=z), Dim("z", t["z"], {"b": "b", "c": "c"}, {"v": "zv"}, inner=z)]
    got = star(root, dims, cut)
    kind = lambda i: "inner" if i else "left"
    tx, ty, tz = t["x"].toDF("xa", "xy", "xv"), t["y"].toDF("yy", "yv"), t["z"].toDF("zb", "zc", "zv")
    want = root.join(tx, F.col("a") == F.col("xa"), kind(x)).join(ty, F.col("xy") == F.col("yy"), kind(y)).join(tz, (F.col("b") == F.col("zb")) & (F.col("c") == F.col("zc")), kind(z))
    assert rows(got) == rows(want.select("id", "a", "b", "c", "xv", "yv", "zv"))
    if not (y and not x):  # a required leaf of an optional branch also decides about the root: join_star tells
        assert rows(join_star(root, dims)) == rows(got)


def test_wide_rows_are_shuffled_once_a_key(spark):
    """Relations by the same key follow each other, and a relation's relations are joined to it, not to the root."""
    root = spark.range(300).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), F.concat(F.lit("wide"), "id").alias("wide"))
    one = spark.createDataFrame([(k, k % 3, f"v{k}") for k in range(7)], "k long, c long, v string")
    dims = [
        Dim("p", one, {"a": "k"}, {"v": "pv"}), Dim("q", one, {"b": "k"}, {"v": "qv"}), Dim("r", one, {"a": "k"}, {"v": "rv"}),
        Dim("s", one, {"c": "k"}, {"v": "sv"}, parent="p"), Dim("t", one, {"b": "k"}, {"v": "tv"}),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = join_star(root, dims)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert {(r.a, r.pv, r.sv) for r in got.collect()} == {(k, f"v{k}", f"v{k % 3}") for k in range(7)} and got.count() == 300
        # p and the wide rows twice (by c and a, by a and b), every other relation once
        assert text.count("Exchange hashpartitioning") == 2 + 2 + 4, text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reducer_leaves_only_what_takes_part(spark):
    root = spark.range(100).select("id", (F.col("id") % 10).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 4).alias("code"))
    code = spark.createDataFrame([(1,), (9,)], "code int")
    r, (d, c) = reduce_star(root, [Dim("d", dim, {"k": "k"}, inner=True), Dim("c", code, {"code": "code"}, parent="d", inner=True)])
    assert {x.k for x in r.collect()} == {1, 5, 9} and {x.k for x in d.df.collect()} == {1, 5, 9} and [x.code for x in c.df.collect()] == [1]
    for bad in ([Dim("d", dim, {"nope": "k"})], [Dim("d", dim, {"k": "nope"})], [Dim("c", code, {"code": "code"}, parent="d")], [Dim("d", dim, {"k": "k"})] * 2):
        with pytest.raises(ValueError):
            reduce_star(root, bad)


def test_pulls_refuse_absent_tables(spark):
    keys = spark.createDataFrame([("a",)], "k string")
    for pull in (billing_pull, order_pull):
        with pytest.raises(ValueError, match="tables missing"):
            pull({"product": keys}, keys, "k")


def test_roles_with_one_join(spark):
    dim = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "id int, value string")
    df = spark.createDataFrame([(1, 0, 1, None), (2, 4, 4, 4), (3, None, None, None), (4, 9, 0, 2), (2, 4, 4, 4)], "k int, a int, b int, c int")
    roles = {"ra": "a", "rb": "b", "rc": "c"}
    out = decode_roles(df, dim, "id", "value", roles)
    v = lambda x: f"v{x}" if x is not None and x < 5 else None
    assert rows(out) == sorted([(*r, *map(v, r[1:])) for r in map(tuple, df.collect())], key=lambda t: tuple((x is None, str(x)) for x in t))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, three = (plan_text(decode_roles(df, dim, "id", "value", r)) for r in ({"ra": "a"}, roles))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one.count("Join") == three.count("Join") and one.count("Exchange") == three.count("Exchange")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a sixth without a key."""
    return spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 997).cast("int").alias("k"), F.col("id"))


@pytest.fixture()
def shuffled(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def sizes(df):
    return sorted(r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(df.columns[-1])).collect())  # a join that no column is read of would not run


def test_hot_keys(skewed):
    assert hot_keys(skewed, ["k"], share=0.05) == ['["7"]']
    assert hot_keys(skewed.limit(0), ["k"]) == [] and hot_keys(skewed.where("k is null"), ["k"]) == []


def test_no_task_holds_the_hot_key(spark, skewed, shuffled):
    """No task of the joined rows is above five times the median; a plain shuffle join has one that is."""
    ref = spark.range(900).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    df = skewed.repartition(16)
    plain, hot = lookup(df, ref, "k", "v", on_multi="first", order=["v"]), lookup(df, ref, "k", "v", on_multi="first", order=["v"], hot=True)
    assert rows(hot) == rows(plain)
    for out, fits in ((plain, False), (hot, True)):
        n = sizes(out)
        assert (n[-1] <= 5 * n[len(n) // 2]) is fits, n
    value = F.when(F.col("id") % 5 == 0, F.col("id").cast("string"))
    with_value = df.withColumn("v", value).withColumn("t", F.lit(None).cast("string"))
    assert rows(propagate_by_key(with_value, "k", "v", "t", ["id"], hot=True)) == rows(propagate_by_key(with_value, "k", "v", "t", ["id"]))
    g = df.groupBy("k").agg(F.max("id").alias("m"))
    out = with_group_value(df, g, "k", hot=True)
    assert rows(out) == rows(with_group_value(df, g, "k"))
    n = sizes(out)
    assert n[-1] <= 5 * n[len(n) // 2]


def test_hot_join_refuses_what_it_cannot_do(spark, skewed):
    twice = spark.createDataFrame([(7, "a"), (7, "b")], "k int, v string")
    with pytest.raises(Exception, match="hot key twice"):
        hot_left_join(skewed, twice, {"k": "k"}).collect()
    for kw in ({"hot": True}, {"hot": True, "on_multi": "first", "order": ["v"], "null_safe": True}):
        with pytest.raises(ValueError):
            lookup(skewed, twice, "k", "v", **kw)


def test_label_sets(spark, skewed):
    df = skewed.withColumn("label", F.when(F.col("id") % 1000 == 3, "rare").when(F.col("id") % 2 == 0, "even").otherwise("other"))
    got = {r.k: r.s for r in group_labels(df, "k", "label", ["even", "rare"], "s").collect()}
    want = {}
    for r in df.where("k is not null").collect():
        want[r.k] = want.get(r.k, 0) | {"even": 1, "rare": 2}.get(r.label, 0)
    assert got == want
    plain = rows(group_category(df, "k", "label", "rare", "any_rare"))
    assert plain == rows(any_match(df, "k", F.col("label") == "rare", "any_rare", per_row=True))
    for kw in ({"cut": cut_lineage}, {"hot": True}, {"cut": cut_lineage, "hot": True}):
        assert rows(group_category(df, "k", "label", "rare", "any_rare", **kw)) == plain
    with pytest.raises(ValueError):
        group_labels(df, "k", "label", [str(k) for k in range(64)], "s")


def test_group_actionable_plans_each_input_once(spark):
    from reckon.plans.registry import QUERIES

    plan = plan_text(QUERIES["group_actionable"](spark, "/root/testdata/sf0.001"))
    assert not any(t in plan for t in ("lineitem.parquet", "orders.parquet", "part.parquet")) and "reckon-cut" in plan
