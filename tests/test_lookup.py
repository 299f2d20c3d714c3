from pyspark.sql import functions as F

from helpers import rows
from reckon.operators.lookup import anti_not_in, lookup, propagate_by_key, semi_in


def _frames(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", 5.0), (3, "z", 7.0), (4, None, None), (5, "dup", 1.0)], "id int, k string, v double"
    )
    ref = spark.createDataFrame([("a", 10.0), ("b", None), ("dup", 2.0), ("dup", 3.0), (None, 99.0)], "rk string, rv double")
    return df, ref


def test_modes(spark):
    df, ref = _frames(spark)
    rep = lookup(df, ref, {"k": "rk"}, {"rv": "v"}, mode="replace")
    assert rows(rep, "id", "v") == [(1, 10.0), (2, None), (3, None), (4, None), (5, 2.0), (5, 3.0)]  # fan-out kept
    fill = lookup(df, ref, {"k": "rk"}, {"rv": "v"}, mode="fill", on_multi="first", order=["rv desc"])
    assert rows(fill, "id", "v") == [(1, 10.0), (2, 5.0), (3, 7.0), (4, None), (5, 1.0)]
    ow = lookup(df, ref, {"k": "rk"}, {"rv": "v"}, mode="overwrite", on_multi="first", order=["rv desc"])
    assert rows(ow, "id", "v") == [(1, 10.0), (2, 5.0), (3, 7.0), (4, None), (5, 3.0)]
    assert ow.columns == df.columns


def test_new_column_and_null_keys_never_match(spark):
    df, ref = _frames(spark)
    out = lookup(df, ref, {"k": "rk"}, {"rv": "found"}, on_multi="first", order=["rv"])
    assert out.columns == ["id", "k", "v", "found"]
    assert dict(rows(out, "id", "found"))[4] is None
    ns = lookup(df, ref, {"k": "rk"}, {"rv": "found"}, on_multi="first", order=["rv"], null_safe=True)
    assert dict(rows(ns, "id", "found"))[4] == 99.0


def test_multi_column_key(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "x", 2)], "id int, a string, b int")
    ref = spark.createDataFrame([("x", 1, "hit")], "ra string, rb int, val string")
    out = lookup(df, ref, {"a": "ra", "b": "rb"}, ["val"])
    assert rows(out, "id", "val") == [(1, "hit"), (2, None)]


def test_semi_anti(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,), (3,)], "key int")
    assert rows(semi_in(df, keys, {"k": "key"})) == [(1,), (3,)]
    assert rows(anti_not_in(df, keys, {"k": "key"})) == [(2,), (None,)]  # NOT EXISTS keeps null keys


def test_propagate_first_and_last(spark):
    df = spark.createDataFrame(
        [("s1", 1, None), ("s1", 2, "B"), ("s1", 3, "A"), ("s2", 1, None), ("s3", 1, "C")], "scid string, n int, val string"
    ).withColumn("target", F.lit(None).cast("string"))
    first = propagate_by_key(df, "scid", "val", "target", order=["n"], pick="first")
    assert rows(first, "scid", "n", "target") == [("s1", 1, "B"), ("s1", 2, "B"), ("s1", 3, "B"), ("s2", 1, None), ("s3", 1, "C")]
    last = propagate_by_key(df, "scid", "val", "target", order=["n"], pick="last")
    assert {r[2] for r in rows(last, "scid", "n", "target") if r[0] == "s1"} == {"A"}
    # fill keeps an existing target
    pre = df.withColumn("target", F.when(F.col("n") == 1, F.lit("keep")))
    out = propagate_by_key(pre, "scid", "val", "target", order=["n"], mode="fill")
    assert dict(((r[0], r[1]), r[2]) for r in rows(out, "scid", "n", "target"))[("s1", 1)] == "keep"


def test_hot_key_is_not_capped(spark):
    # One key holds a third of all rows: results stay whole.
    n = 3000
    df = spark.range(n).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"), F.col("id").alias("id"))
    ref = spark.range(n).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("val"))
    out = lookup(df, ref, {"k": "rk"}, ["val"])
    assert out.count() == n
    assert out.where(F.col("k") == 0).count() == n // 3


def test_sieve_keeps_partners_and_few_others(spark):
    """No row with a key is lost, nulls and repeated keys included; of 20,000 others some 6 % are left before the join."""
    from pyspark.sql import functions as F

    from reckon.operators.lookup import semi_in, sieved

    df = spark.range(20_100).select((F.col("id") - 50).alias("n"), F.concat(F.lit("k"), F.col("id") - 50).alias("s"), F.lit("x").alias("v"))
    df = df.union(spark.createDataFrame([(None, None, "x")], "n long, s string, v string"))
    keys = spark.range(-100, 100).select(F.col("id").alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b"), F.col("id").cast("int").alias("c"))
    keys = keys.union(keys).union(spark.createDataFrame([(None, None, None)], "a long, b string, c int"))
    for on in ({"n": "a"}, {"s": "b"}, {"n": "a", "s": "b"}):
        met = sieved(df, keys, on)
        assert met.columns == df.columns and met.where("n < 100 and n >= -50").count() == 150 and met.count() < 3000
        assert rows(semi_in(df, keys, on, sieve=True)) == rows(semi_in(df, keys, on))
    assert sieved(df, keys, {"n": "c"}).count() == 20_101  # types differ: not sieved
    assert semi_in(df, keys.limit(0), {"n": "a"}, sieve=True).count() == 0


def test_sieve_comes_before_the_shuffle(spark):
    """The semi-join's shuffle holds the sieved rows, not all rows."""
    from helpers import plan_text

    df, keys = spark.range(1000).selectExpr("id as n", "id as m"), spark.range(5).selectExpr("id as a")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(semi_in(df, keys, {"n": "a"}, sieve=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tree = text.split("\n\n")[0]
    assert tree.index("SortMergeJoin LeftSemi") < tree.index("Exchange") < tree.index("BroadcastHashJoin LeftSemi")
