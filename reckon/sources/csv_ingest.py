"""CSV ingest: a glob of delimited files with a header row into a table.

Header names are trimmed; an unnamed first column can be given a name;
values are read with an explicit schema (no inference pass over the data).
The header line is skipped by the reader (``header=True``), not by
position. Appends are atomic per job through Spark's file committer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_glob(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType | str | None = None,
    first_col_name: str | None = None,
    sep: str = ",",
    check_header: bool = False,
) -> DataFrame:
    """A malformed row (too few or many fields, a value that is not of its
    type) fails the read instead of becoming nulls. With ``check_header``
    every file's header must name the schema's columns in its order."""
    r = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", not check_header)
        df = r.csv(pattern)
    else:
        df = r.option("inferSchema", False).csv(pattern)
    names = [c.strip() for c in df.columns]
    if first_col_name and names and (names[0] == "" or names[0].startswith("_c0") or names[0].lower().startswith("unnamed")):
        names[0] = first_col_name
    return df.toDF(*names)


def ingest_csv(
    spark: SparkSession,
    pattern: str,
    target: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    first_col_name: str | None = None,
    check_header: bool = False,
) -> DataFrame:
    """Append the rows of every file matching ``pattern`` to ``target``."""
    df = read_csv_glob(spark, pattern, schema, first_col_name, check_header=check_header)
    df.write.mode("append").format(fmt).save(target)
    return spark.read.format(fmt).load(target)


# Column list of the invoice CSV drop (fixed values, in file order).
INVOICE_CSV_COLUMNS = [
    "test", "billing_level", "prep_date", "statement_date", "prep_status", "bus_org_id",
    "bill_company", "ban", "from_date", "to_date", "package", "description_text", "currency",
    "amount", "primary_id", "piid", "package_id", "type_code", "annotation", "discount",
    "discount_id", "subtype_code",
]

INVOICE_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in INVOICE_CSV_COLUMNS])
