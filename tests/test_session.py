from reckon.session import apply_conf, checkpoint_dir, scale_conf


def test_scale_conf_100tb():
    c = scale_conf(100 * 10**12, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert 100 * 10**12 / n <= 256 << 20  # no partition above the target before AQE
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_scale_conf_small_uses_cores():
    assert scale_conf(10 << 20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_apply_conf_and_checkpoint_dir(spark):
    apply_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 << 20)})
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in (str(64 << 20), "64m", "67108864b")
    assert checkpoint_dir(spark)


def test_cut_lineage_formats(spark):
    from pyspark.sql import functions as F

    from reckon.session import cut_lineage

    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id"))
    for fmt in ("parquet", "checkpoint"):
        cut = cut_lineage(df.groupBy("k").count(), fmt=fmt)
        assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.groupBy("k").count().collect())
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan  # the aggregate is behind the cut
