"""Run a job from the command line.

    python -m reckon.cli forecast   --tables tables.json --year 2025 --prev may --curr june --out BASE --cycle 2025-06
    python -m reckon.cli validator  --tables tables.json --year 2025 --month 6 --day 31 --out BASE --cycle 2025-06-31
    python -m reckon.cli cycle-prep --tables tables.json --year 2025 --month 6 --day 31 --out BASE --cycle 2025-06-31
    python -m reckon.cli classify   --tables tables.json --run-date 2025-06-17 --out BASE --cycle 2025-06
    python -m reckon.cli ingest-csv --source 'drop/*.csv' --target TABLE [--stream --checkpoint DIR]

``tables.json`` maps logical table names (see FIXTURES.md) to a path or to
``{"path": ..., "format": ..., "options": {...}}``. Outputs are written
with ``write_outputs`` (one parquet folder per name, partitioned by cycle).
The session is taken as configured by the platform (``spark-submit``).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import SparkSession

from reckon.sources.catalog import Catalog, TableSpec
from reckon.sources.sink import write_outputs


def load_tables(spark: SparkSession, path: str) -> dict:
    with open(path) as f:
        spec = json.load(f)
    specs = {k: TableSpec(v) if isinstance(v, str) else TableSpec(**v) for k, v in spec.items() if not k.startswith("_")}
    cat = Catalog(spark, specs)
    return {k: cat.table(k) for k in specs}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="reckon")
    p.add_argument("--input-bytes", type=int, help="size the shuffle/scan partitions for this much input (see session.scale_conf)")
    p.add_argument("--cores", type=int, help="total executor cores, with --input-bytes")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("forecast", "validator", "cycle-prep", "classify"):
        s = sub.add_parser(name)
        s.add_argument("--tables", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--cycle", required=True)
        s.add_argument("--year", type=int)
        s.add_argument("--month", type=int)
        s.add_argument("--day", type=int)
        s.add_argument("--prev", default="prev")
        s.add_argument("--curr", default="curr")
        s.add_argument("--run-date")
    s = sub.add_parser("ingest-csv")
    s.add_argument("--source", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--stream", action="store_true")
    s.add_argument("--checkpoint")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.input_bytes:
        from reckon.session import apply_conf, scale_conf

        apply_conf(spark, scale_conf(a.input_bytes, a.cores or spark.sparkContext.defaultParallelism))

    if a.job == "ingest-csv":
        from reckon.sources.csv_ingest import INVOICE_CSV_SCHEMA, ingest_csv

        if a.stream:
            import os

            from reckon.streaming.ingest import ingest_csv_stream

            ingest_csv_stream(spark, os.path.dirname(a.source), INVOICE_CSV_SCHEMA, a.target, a.checkpoint,
                              pattern=os.path.basename(a.source) or "*.csv")
        else:
            ingest_csv(spark, a.source, a.target, schema=INVOICE_CSV_SCHEMA)
        return {"table": a.target}

    t = load_tables(spark, a.tables)
    if a.job == "forecast":
        from reckon.plans.forecast import forecast_compare

        outs = forecast_compare(t["forecast_history"], t["forecast_current"], a.year, a.prev, a.curr)
    elif a.job == "validator":
        from reckon.plans.validator import validator_update

        outs = {"PIID Changes": validator_update(t["validation_log"], t["rate_header"], a.month, a.day, a.year)}
    elif a.job == "cycle-prep":
        from reckon.plans.cycle_prep import cycle_prep

        outs = cycle_prep(t, a.year, a.month, a.day)
    else:
        from reckon.plans.classify import classify_circuits

        run = _dt.date.fromisoformat(a.run_date)
        outs = classify_circuits(t["circuit_input"], t["margin_service"], t["margin_circuit"], t["gl_account"], t["expense_snapshot"],
                                 t["billing"] if "billing" in t else t, t["rerate_history"], run)
    safe = {k.replace(" ", "_"): v for k, v in outs.items()}
    return write_outputs(safe, a.out, a.cycle)


def run() -> int:
    """Console entry point: run the job, print the written outputs, exit 0."""
    for name, path in main().items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(run())
