"""A third of all rows on one key: results stay whole and the default
roll-up paths plan no window (no single task sorts the hot group), and the
sort-merge joins of chained lookups split the hot partition."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_text
from reckon.operators.lookup import lookup, propagate_by_key, semi_in
from reckon.operators.rollup import any_match, complete_group_max, first_per_group, priority_rollup

N = 30000


def _skewed(spark):
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id"),
        F.when(F.col("id") % 7 == 0, F.lit("R")).otherwise(F.lit("N")).alias("flag"),
    )


def test_rollups_on_hot_key(spark):
    df = _skewed(spark)
    pr = priority_rollup(df, "k", "flag", ["R", "N"], None, "g", per_row=True)
    assert pr.count() == N
    assert pr.where("k = 0").select("g").distinct().collect()[0].g == "R"
    am = any_match(df, "k", F.col("flag") == "R", "any_r")
    assert am.where("k = 0").first().any_r is True
    cg = complete_group_max(df, "k", "id", F.lit(True), "m")
    assert cg.where("k = 0").first().m == (N - 1) - (N - 1) % 3
    fp = first_per_group(df, "k", ["id desc"])
    assert fp.where("k = 0").first().id == (N - 1) - (N - 1) % 3
    for d in (pr, am, cg, fp):
        assert " Window " not in plan_text(d) and "Window (" not in plan_text(d)


def test_propagate_and_semi_on_hot_key(spark):
    df = _skewed(spark).withColumn("t", F.lit(None).cast("string"))
    out = propagate_by_key(df, "k", "flag", "t", order=["id"], mode="fill")
    assert out.count() == N
    assert out.where("k = 0").select("t").distinct().collect()[0].t == "R"  # id 0 is the first row of the hot key
    keys = _skewed(spark).select("k")  # the hot key repeated N/3 times on the key side
    assert semi_in(_skewed(spark), keys, "k").count() == N


@pytest.fixture
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_chained_lookups_split_the_hot_key(spark, skew_conf):
    refs = [spark.range(N).select(F.col("id").alias("rk"), (F.col("id") * i).alias(f"v{i}")) for i in (1, 2, 3)]
    df = _skewed(spark).repartition(8)
    for i, ref in enumerate(refs, 1):
        df = lookup(df, ref, {"k": "rk"}, [f"v{i}"])
    assert len(df.collect()) == N
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin(skew=true)") == 3, plan
