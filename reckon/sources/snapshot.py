"""Month-suffixed snapshots as one partitioned table.

Instead of editing a table name each month, snapshots live in one table
partitioned by an integer ``snapshot`` column (yyyymm). Selecting the
previous month's snapshot is a literal equality on the partition column,
so only that partition's files are listed and read. The newest one
(``newest_snapshot``) is found from the partitions' names, not by a scan."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def prev_period(run_date: _dt.date) -> int:
    y, m = run_date.year, run_date.month - 1
    if m == 0:
        y, m = y - 1, 12
    return y * 100 + m


def previous_snapshot(df: DataFrame, run_date: _dt.date, col: str = "snapshot") -> DataFrame:
    """Rows of the snapshot taken for the month before ``run_date``."""
    return df.where(F.col(col) == F.lit(prev_period(run_date))).drop(col)


def previous_month_rows(df: DataFrame, ts_col: str, run_date: _dt.date) -> DataFrame:
    """Rows whose timestamp falls in the month before ``run_date``, as a
    half-open range on the raw column (pushed down to the scan)."""
    first = run_date.replace(day=1)
    prev = (first - _dt.timedelta(days=1)).replace(day=1)
    from reckon.functions.dates import ts_literal

    lo = ts_literal(df, ts_col, _dt.datetime(prev.year, prev.month, 1))
    hi = ts_literal(df, ts_col, _dt.datetime(first.year, first.month, 1))
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def write_snapshot(df: DataFrame, path: str, col: str = "snapshot") -> None:
    """Add the snapshots that ``df`` holds to the table at ``path``; one already there is replaced whole, others stay."""
    df.repartition(col).write.partitionBy(col).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def snapshots(spark: SparkSession, path: str, col: str = "snapshot") -> list[int]:
    """The snapshots at ``path``, newest first, from the names of the partition folders (one
    listing of the table's folder, as many names as months were kept)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
    return sorted((int(n.split("=", 1)[1]) for n in names if n.startswith(f"{col}=") and n.split("=", 1)[1].isdigit()), reverse=True)


def newest_snapshot(spark: SparkSession, path: str, col: str = "snapshot") -> DataFrame:
    """Rows of the newest snapshot with any rows: what ``latest_snapshot`` returns, without the
    scan for the maximum. The value reaches the scan as a literal, so one partition is read. A
    partition without rows is passed over, as it has no part in a maximum; the null partition never
    is the newest. A table without snapshots gives no rows."""
    df = spark.read.parquet(path)
    for value in snapshots(spark, path, col):
        newest = df.where(F.col(col) == F.lit(value))
        if not newest.isEmpty():
            return newest
    return df.where(F.lit(False))
