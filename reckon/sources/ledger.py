"""Repeatable batch ingest of delimited files.

A ledger table has one row for every file that was taken in (path, length,
batch). A run takes the files that the ledger does not have, writes their lines
into a batch of its own, malformed ones set aside with their file, and then enters all its files into the ledger with one append. A batch that the
ledger does not name is not part of the table, so a run that dies can be repeated,
and a rerun without new files adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_DDL = "path string, length long, batch string"
_CORRUPT, LINE, FILE = "__corrupt_line", "__line", "__line_file"


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException:  # not written yet
        return spark.createDataFrame([], ddl)


def new_files(spark: SparkSession, pattern: str, ledger: str) -> DataFrame:
    """path, length of the files of ``pattern`` that the ledger does not have; a file that grew is new."""
    try:
        files = spark.read.format("binaryFile").load(pattern).select("path", "length")  # contents are not read
    except AnalysisException:  # no file matches
        return spark.createDataFrame([], "path string, length long")
    return files.join(_table(spark, ledger, LEDGER_DDL), ["path", "length"], "left_anti")


def ingest_files(spark: SparkSession, pattern: str, target: str, schema: T.StructType, sep: str = ",") -> dict[str, int]:
    """Takes the new files of ``pattern`` into ``target``; numbers of files, rows and quarantined lines.

    ``target`` holds the folders ``rows`` and ``ledger``. A line with too few or too many
    fields, or a value not of its type, goes to the quarantine as it is, with its file; all others are
    rows. Header lines are skipped. Read the result with ``read_rows`` and ``read_quarantine``.
    """
    root, batch = target.rstrip("/"), uuid.uuid4().hex
    files = new_files(spark, pattern, f"{root}/ledger").withColumn("batch", F.lit(batch))
    taken = files.collect()  # the driver lists the files of a read in any case
    if not taken:
        return {"files": 0, "rows": 0, "quarantined": 0}
    own = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    read = spark.read.schema(own).option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    lines = read.csv([r.path for r in taken]).select("*", F.col("_metadata.file_path").alias("__file"))
    path = f"{root}/rows/batch={batch}"
    # one pass: a malformed line keeps its text and file beside the columns
    set_aside = F.col(_CORRUPT).isNotNull()
    lines.select(*[f.name for f in schema.fields], F.col(_CORRUPT).alias(LINE), F.when(set_aside, F.col("__file")).alias(FILE)).write.mode("errorifexists").parquet(path)
    count = spark.read.parquet(path).agg(F.count("*").alias("n"), F.count(LINE).alias("bad")).first()
    n = {"files": len(taken), "rows": count.n - count.bad, "quarantined": count.bad}
    spark.createDataFrame(taken, LEDGER_DDL).coalesce(1).write.mode("append").parquet(f"{root}/ledger")  # one file: all or nothing
    return n


def _batches(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Lines of the batches that the ledger names; the others' folders are not opened."""
    root = target.rstrip("/")
    done = [r.batch for r in _table(spark, f"{root}/ledger", LEDGER_DDL).select("batch").distinct().collect()]  # one a run
    whole = T.StructType([*schema.fields, T.StructField(LINE, T.StringType()), T.StructField(FILE, T.StringType())])
    if not done:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(*[f"{root}/rows/batch={b}" for b in done])


def read_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    return _batches(spark, target, schema).where(F.col(LINE).isNull()).drop(LINE, FILE)


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """file, line of everything that was set aside."""
    return _batches(spark, target, T.StructType([])).where(F.col(LINE).isNotNull()).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"))
