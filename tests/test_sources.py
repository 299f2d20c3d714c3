import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import plan_text, rows
from reckon.sources.catalog import Catalog, TableSpec, save_bucketed
from reckon.sources.csv_ingest import INVOICE_CSV_SCHEMA, ingest_csv, read_csv_glob
from reckon.sources.sink import read_output, write_outputs
from reckon.sources.snapshot import newest_snapshot, previous_snapshot, snapshots, write_snapshot


def test_csv_glob_trimmed_headers_and_append(spark):
    d = tempfile.mkdtemp(prefix="reckon-csv-")
    for i in range(2):
        with open(os.path.join(d, f"part{i}.csv"), "w") as f:
            f.write(" ,  name , amount \n")
            f.write(f"{i},n{i},{i}.5\n")
    with open(os.path.join(d, "other.txt"), "w") as f:
        f.write("not matched\n")
    df = read_csv_glob(spark, f"{d}/*.csv", first_col_name="row_id")
    assert df.columns == ["row_id", "name", "amount"]
    assert rows(df) == [("0", "n0", "0.5"), ("1", "n1", "1.5")]  # header row skipped per file
    target = tempfile.mkdtemp(prefix="reckon-tbl-") + "/t"
    ingest_csv(spark, f"{d}/*.csv", target, first_col_name="row_id")
    out = ingest_csv(spark, f"{d}/*.csv", target, first_col_name="row_id")
    assert out.count() == 4  # appended twice


def test_invoice_schema_is_explicit(spark):
    assert len(INVOICE_CSV_SCHEMA.fields) == 22 and INVOICE_CSV_SCHEMA.fields[0].name == "test"


def test_named_outputs_per_cycle(spark):
    base = tempfile.mkdtemp(prefix="reckon-out-")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    write_outputs({"a": a, "b": a.where("x = 1")}, base, "2025-05")
    write_outputs({"a": a.where("x = 2")}, base, "2025-06")
    write_outputs({"a": a}, base, "2025-06")  # rerun of a cycle replaces only that cycle
    assert rows(read_output(spark, base, "a", "2025-05")) == [(1,), (2,)]
    assert rows(read_output(spark, base, "a", "2025-06")) == [(1,), (2,)]
    assert rows(read_output(spark, base, "b", "2025-05")) == [(1,)]


def test_empty_rerun_clears_its_cycle_alone(spark):
    base = tempfile.mkdtemp(prefix="reckon-out-")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    for cycle in ("2025-05", "2025-06"):
        write_outputs({"a": a}, base, cycle)
    write_outputs({"a": a.where("x > 9"), "never": a.limit(0)}, base, "2025-06")
    assert rows(read_output(spark, base, "a", "2025-06")) == [] and rows(read_output(spark, base, "a", "2025-05")) == [(1,), (2,)]
    assert read_output(spark, base, "never", "2025-06").columns == ["x"] and rows(read_output(spark, base, "never", "2025-06")) == []


@pytest.mark.parametrize("text", ["a,b\n1,x\nbad,y\n", "a,b\n1,x\n2\n", "b,a\n1,x\n"])
def test_csv_malformed_rows_and_headers_fail(spark, text):
    d = tempfile.mkdtemp(prefix="reckon-csv-")
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        read_csv_glob(spark, f"{d}/*.csv", "a int, b string", check_header=True).collect()


def test_snapshot_partition_pruning(spark):
    base = tempfile.mkdtemp(prefix="reckon-snap-") + "/snap"
    df = spark.createDataFrame([("c1", "Y", 1, 202504), ("c1", "N", 1, 202505), ("c2", "Y", 2, 202505)],
                               "stripped_ec_circuit_id string, active_ind string, dw_secure_company_nbr int, snapshot int")
    df.write.partitionBy("snapshot").parquet(base)
    snap = previous_snapshot(spark.read.parquet(base), dt.date(2025, 6, 17))
    assert rows(snap) == [("c1", "N", 1), ("c2", "Y", 2)]
    plan = plan_text(snap)
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "202505" in plan


def test_catalog_pushdown(spark):
    cat = Catalog(spark, {"orders": TableSpec("/root/testdata/sf0.001/orders.parquet")})
    df = cat.table("orders", columns=["o_orderkey"], o_orderstatus="F")
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(F.col("o_orderstatus") == "F").count()


def test_catalog_csv_with_normalisation(spark):
    d = tempfile.mkdtemp(prefix="reckon-cat-")
    with open(os.path.join(d, "q.csv"), "w") as f:
        f.write("Unique Product PRCMP,Quantity Status\n")
        f.write("PCPR,Always > 1\n")
        f.write("PCX,\n")
    cat = Catalog(spark, {"quantity_guide": TableSpec(f"{d}/q.csv", format="csv", options={"header": "true"},
                                                       blanks_to_null=True, lower_names=True)})
    df = cat.table("quantity_guide")
    assert df.columns == ["unique_product_prcmp", "quantity_status"]
    assert rows(df) == [("PCPR", "Always > 1"), ("PCX", None)]
    assert rows(cat.table("quantity_guide", columns=["unique_product_prcmp"], quantity_status=["Always > 1"])) == [("PCPR",)]


def test_outputs_all_or_nothing(spark, tmp_path):
    """A failure in the third output leaves the cycle's old outputs readable, also those already rewritten."""
    from reckon.sources.sink import output_names

    base, old, new = str(tmp_path), spark.range(3), spark.range(9)
    with pytest.raises(FileNotFoundError):
        read_output(spark, base, "a", "2025-06")
    write_outputs({"a": old, "b": old, "c": old}, base, "2025-06")
    bad = new.select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_outputs({"a": new, "b": new, "c": bad}, base, "2025-06")
    with pytest.raises(Exception, match="lost"):
        write_outputs({"a": bad}, base, "2025-07")  # a cycle's first run
    assert [read_output(spark, base, n, "2025-06").count() for n in "abc"] == [3, 3, 3] and output_names(spark, base, "2025-07") == []
    write_outputs({"a": new, "b": new}, base, "2025-06")
    assert output_names(spark, base, "2025-06") == ["a", "b"] and read_output(spark, base, "a", "2025-06").count() == 9
    with pytest.raises(FileNotFoundError):
        read_output(spark, base, "c", "2025-06")


def test_ledger_ingest(spark, tmp_path):
    from pyspark.sql import types as T

    from reckon.sources import ledger

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    drops, target = tmp_path / "drops", str(tmp_path / "table")
    drops.mkdir()
    run = lambda: ledger.ingest_files(spark, f"{drops}/*.csv", target, schema)
    assert run() == {"files": 0, "rows": 0, "quarantined": 0} and rows(ledger.read_rows(spark, target, schema)) == []
    (drops / "a.csv").write_text("k,v\n1,x\nbad,y\n2,\n3,z,too many\n")
    assert run() == {"files": 1, "rows": 2, "quarantined": 2}
    assert run() == {"files": 0, "rows": 0, "quarantined": 0}
    (drops / "b.csv").write_text("k,v\n4,w\n")
    (drops / "empty.csv").write_text("k,v\n")
    assert run() == {"files": 2, "rows": 1, "quarantined": 0}
    assert rows(ledger.read_rows(spark, target, schema)) == [(1, "x"), (2, None), (4, "w")]
    assert sorted((r.file.rsplit("/", 1)[-1], r.line) for r in ledger.read_quarantine(spark, target).collect()) == [("a.csv", "3,z,too many"), ("a.csv", "bad,y")]
    # a run that died before its files were entered leaves a batch that nobody reads
    spark.createDataFrame([(9, "lost")], schema).write.parquet(f"{target}/rows/batch=dead")
    assert (9, "lost") not in rows(ledger.read_rows(spark, target, schema))
    (drops / "b.csv").write_text("k,v\n4,w\n5,more\n")  # a file that grew is new
    assert run()["files"] == 1


def test_named_and_bucketed_tables(spark, tmp_path):
    """Tables with equal buckets join without an exchange, null keys and a hot key included; names and paths in one catalog."""
    left = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).when(F.col("id") % 9 > 0, 7).alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w"))
    specs = {"left": save_bucketed(left, "t_left", ["k"], 4, str(tmp_path / "l")), "right": save_bucketed(right, "t_right", ["rk"], 4, str(tmp_path / "r"))}
    right.write.parquet(str(tmp_path / "plain"))
    cat = Catalog(spark, specs | {"plain": str(tmp_path / "plain")})
    joined = cat.table("left").join(cat.table("right").hint("merge"), F.col("k") == F.col("rk"), "left").select("v", "w")
    assert "Exchange" not in plan_text(joined) and "SortMergeJoin" in plan_text(joined)
    assert "Exchange" in plan_text(cat.table("left").join(cat.table("plain").hint("merge"), F.col("k") == F.col("rk")))
    assert rows(joined) == rows(left.join(right, F.col("k") == F.col("rk"), "left").select("v", "w"))
    assert cat.table("left", ["v"], k=7).count() == left.where("k = 7").count()
    assert len([f for f in os.listdir(tmp_path / "l") if f.endswith(".parquet")]) <= 4  # a file a bucket
    with pytest.raises(Exception, match="exist"):
        save_bucketed(right, "t_right", ["rk"], 4, str(tmp_path / "r"))
    empty = Catalog(spark, {"e": save_bucketed(left.limit(0), "t_empty", ["k"], 4, str(tmp_path / "e"))}).table("e")
    assert empty.columns == ["k", "v"] and empty.count() == 0
    for bad in (dict(), dict(path="a", table="b"), dict(table="b", schema="k long")):
        with pytest.raises(ValueError):
            TableSpec(**bad)


def test_newest_snapshot(spark, tmp_path):
    """The newest snapshot from the partitions' names: one partition is read, those without rows do not count."""
    path = str(tmp_path / "s")
    data = spark.createDataFrame([(1, 202411), (2, 202412), (3, 202501), (4, 202501), (5, None)], "v int, snapshot int")
    write_snapshot(data, path)
    assert snapshots(spark, path) == [202501, 202412, 202411]
    assert rows(newest_snapshot(spark, path)) == [(3, 202501), (4, 202501)]
    plan = plan_text(newest_snapshot(spark, path))
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "= 202501" in plan and "Aggregate" not in plan
    write_snapshot(spark.createDataFrame([(9, 202501)], "v int, snapshot int"), path)  # a rerun replaces its month alone
    assert rows(newest_snapshot(spark, path)) == [(9, 202501)] and spark.read.parquet(path).count() == 4
    spark.createDataFrame([], "v int").write.parquet(f"{path}/snapshot=202502")
    assert snapshots(spark, path)[0] == 202502 and rows(newest_snapshot(spark, path)) == [(9, 202501)]
    write_snapshot(data.where("snapshot is null"), str(tmp_path / "n"))
    assert newest_snapshot(spark, str(tmp_path / "n")).count() == 0
