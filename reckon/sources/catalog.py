"""Logical table catalog: one place maps a logical name to a reader spec,
so several physical sources (parquet folders, CSV drops, named tables of the
session catalog, JDBC tables the caller configures) feed one plan. Filters and
column pruning are left to Catalyst and reach the scan (``PushedFilters`` /
``ReadSchema``).

``save_bucketed`` writes a named table bucketed and sorted by its join keys:
tables with the same number of buckets join on them without an exchange, so
that the shuffle is paid once, at the write, and not by every reader."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.functions.columns import blank_to_null


@dataclass(frozen=True)
class TableSpec:
    """A source by ``path`` and format, or by the name of a ``table`` (exactly one of them)."""

    path: str | None = None
    format: str = "parquet"
    options: dict = field(default_factory=dict)
    schema: str | None = None
    blanks_to_null: bool = False
    lower_names: bool = False
    table: str | None = None

    def __post_init__(self):
        if (self.path is None) == (self.table is None):
            raise ValueError("a source has either a path or a table name")
        if self.table is not None and (self.schema or self.options):
            raise ValueError(f"table {self.table}: schema and options are those of the table")


class Catalog:
    def __init__(self, spark: SparkSession, specs: dict[str, TableSpec | str]):
        self.spark = spark
        self.specs = {k: (TableSpec(v) if isinstance(v, str) else v) for k, v in specs.items()}

    @classmethod
    def parquet_dir(cls, spark: SparkSession, base: str, names: list[str]) -> "Catalog":
        return cls(spark, {n: TableSpec(f"{base.rstrip('/')}/{n}.parquet") for n in names})

    def table(self, name: str, columns: list[str] | None = None, where=None, **equals) -> DataFrame:
        """Read ``name``; optional projection, predicate and ``col=value``
        equality filters (all pushed to the scan by Catalyst)."""
        s = self.specs[name]
        if s.table is not None:
            df = self.spark.read.table(s.table)
        else:
            r = self.spark.read.format(s.format).options(**s.options)
            if s.schema:
                r = r.schema(s.schema)
            df = r.load(s.path)
        if s.lower_names:
            df = df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])
        if s.blanks_to_null:
            df = blank_to_null(df)
        for k, v in equals.items():
            df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == F.lit(v))
        if where is not None:
            df = df.where(where)
        if columns:
            df = df.select(*columns)
        return df


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> TableSpec:
    """Write ``df`` as the named table ``name``, bucketed and sorted by ``keys``, and return its spec.

    Rows are dealt by the same hash before the write, so that each bucket is one file (a task that held
    rows of all buckets would write a file for each). Rows with a null key form a bucket with
    others. ``path`` keeps the files there (an external table; the catalog entry lasts as long as the
    session's catalog), else they go to the warehouse. An existing table is an error."""
    w = df.repartition(buckets, *keys).write.format("parquet").mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", path) if path else w).saveAsTable(name)
    return TableSpec(table=name)


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def driver_tables(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog.parquet_dir(spark, sf_dir, _TABLES)
