import os
import tempfile

from pyspark.sql import types as T

from reckon.streaming.ingest import ingest_csv_stream

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.StringType())])


def _drop(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write("id,amount\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_each_file_ingested_once(spark):
    src = tempfile.mkdtemp(prefix="reckon-drop-")
    base = tempfile.mkdtemp(prefix="reckon-stream-")
    target, ckpt = f"{base}/table", f"{base}/_checkpoint"
    _drop(src, "a.csv", [("1", "10"), ("2", "20")])
    _drop(src, "skip.txt", [("9", "9")])
    ingest_csv_stream(spark, src, SCHEMA, target, ckpt)
    assert spark.read.parquet(target).count() == 2
    ingest_csv_stream(spark, src, SCHEMA, target, ckpt)  # rerun without new files: nothing added
    assert spark.read.parquet(target).count() == 2
    _drop(src, "b.csv", [("3", "30")])
    ingest_csv_stream(spark, src, SCHEMA, target, ckpt)
    got = sorted(r.id for r in spark.read.parquet(target).collect())
    assert got == ["1", "2", "3"]
