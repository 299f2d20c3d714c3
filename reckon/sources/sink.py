"""Named-output sink: many named result tables per run, all or nothing.

A run writes each output into a folder of its own attempt,
``<base>/<name>/cycle=<cycle>/attempt=<id>``, and then publishes the attempt with
one row of ``<base>/_manifest``, which names all its outputs. Readers take the
attempt that the manifest names last for a cycle. A run that fails in any of its
outputs publishes nothing: the earlier result of the cycle stays whole and
readable. Outputs of a cycle that a later attempt does not have are no longer
part of it. An empty result is written too (its schema). Both writes go through
Spark's committer, so a lost executor's task is retried without partial files
becoming visible. Folders of replaced or failed attempts stay until removed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"
_MANIFEST_DDL = "cycle string, seq long, attempt string, names array<string>"


def write_outputs(outputs: dict[str, DataFrame], base: str, cycle: str, fmt: str = "parquet") -> dict[str, str]:
    """Writes all outputs and publishes them; the folder of each."""
    if not outputs:
        raise ValueError("no outputs")
    attempt, paths = uuid.uuid4().hex, {}
    for name, df in outputs.items():
        paths[name] = _folder(base, name, cycle, attempt)
        df.write.mode("errorifexists").format(fmt).save(paths[name])
    spark = next(iter(outputs.values())).sparkSession
    last = _published(spark, base, cycle)
    row = [(cycle, (last.seq if last else 0) + 1, attempt, list(outputs))]
    spark.createDataFrame(row, _MANIFEST_DDL).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/{MANIFEST}")
    return paths


def read_output(spark: SparkSession, base: str, name: str, cycle: str, fmt: str = "parquet") -> DataFrame:
    """One named output of the published attempt of one cycle."""
    last = _published(spark, base, cycle)
    if last is None or name not in last.names:
        raise FileNotFoundError(f"{base}: no published output {name} of cycle {cycle}")
    return spark.read.format(fmt).load(_folder(base, name, cycle, last.attempt))


def output_names(spark: SparkSession, base: str, cycle: str) -> list[str]:
    """Names of the outputs that are published for a cycle."""
    last = _published(spark, base, cycle)
    return list(last.names) if last else []


def _published(spark: SparkSession, base: str, cycle: str):
    """The manifest's last row of a cycle, or None."""
    try:
        rows = spark.read.schema(_MANIFEST_DDL).parquet(f"{base.rstrip('/')}/{MANIFEST}")
    except AnalysisException:  # nothing was published yet
        return None
    return rows.where(F.col("cycle") == cycle).orderBy(F.desc("seq"), F.desc("attempt")).first()


def _folder(base: str, name: str, cycle: str, attempt: str) -> str:
    return f"{base.rstrip('/')}/{name}/cycle={cycle}/attempt={attempt}"
