import datetime as dt
import json
import os
import tempfile

from reckon.cli import main
from reckon.sources.sink import read_output


def test_cli_forecast(spark):
    base = tempfile.mkdtemp(prefix="reckon-cli-")
    f = dt.datetime(2025, 5, 28)
    spark.createDataFrame([("I", "up", dt.datetime(2025, 1, 3), 100.0, f)],
                          "initiative string, rerate_type string, rerate_month timestamp, increase double, finalized_date timestamp") \
        .write.parquet(f"{base}/hist")
    spark.createDataFrame([("I", "up", dt.datetime(2025, 1, 9), 130.0)],
                          "initiative string, rerate_type string, rerate_month timestamp, increase double").write.parquet(f"{base}/curr")
    tables = os.path.join(base, "tables.json")
    with open(tables, "w") as fh:
        json.dump({"forecast_history": f"{base}/hist", "forecast_current": {"path": f"{base}/curr", "format": "parquet"}}, fh)
    paths = main(["forecast", "--tables", tables, "--year", "2025", "--prev", "may", "--curr", "june", "--out", f"{base}/out",
                  "--cycle", "2025-06"], spark=spark)
    assert set(paths) == {"may", "june", "compare"}
    r = read_output(spark, f"{base}/out", "compare", "2025-06").first()
    assert (r.may_sum_increase, r.june_sum_increase, r.percent_diff, r.over_20_increase) == (100.0, 130.0, 30.0, 1)


def _save(spark, df, base, name):
    path = f"{base}/{name}"
    df.write.parquet(path)
    return path


def test_cli_validator_and_classify(spark):
    import test_job_classify as C

    base = tempfile.mkdtemp(prefix="reckon-cli-")
    t = C._tables(spark)
    spec = {}
    for name, df in t.items():
        spec["circuit_input" if name == "circuits" else ("billing" if name == "billing" else name)] = _save(spark, df, base, name)
    tables = os.path.join(base, "tables.json")
    with open(tables, "w") as fh:
        json.dump(spec, fh)
    paths = main(["classify", "--tables", tables, "--run-date", "2025-06-17", "--out", f"{base}/out", "--cycle", "2025-06"], spark=spark)
    assert "final" in paths
    final = read_output(spark, f"{base}/out", "final", "2025-06")
    assert final.count() == len(C.CASES) + 5
    assert final.where("input_ecckt_stripped_name = 'C22'").first().nonactionable_reason == C.L.zero_biller


def test_example_tables_file_parses():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples", "tables.example.json")
    with open(path) as fh:
        spec = json.load(fh)
    assert "rate_detail" in spec and "_comment" in spec


def test_cli_ingest_csv_batch_and_stream(spark):
    from reckon.sources.csv_ingest import INVOICE_CSV_COLUMNS

    src = tempfile.mkdtemp(prefix="reckon-drop-")
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(",".join(["Unnamed: 0"] + INVOICE_CSV_COLUMNS[1:]) + "\n")
        fh.write(",".join(["0"] + [f"v{i}" for i in range(1, len(INVOICE_CSV_COLUMNS))]) + "\n")
    base = tempfile.mkdtemp(prefix="reckon-ingest-")
    main(["ingest-csv", "--source", f"{src}/*.csv", "--target", f"{base}/batch"], spark=spark)
    batch = spark.read.parquet(f"{base}/batch")
    assert batch.columns == INVOICE_CSV_COLUMNS and batch.count() == 1
    for _ in range(2):  # a rerun of the stream adds nothing
        main(["ingest-csv", "--source", f"{src}/*.csv", "--target", f"{base}/stream", "--stream", "--checkpoint", f"{base}/ckpt"], spark=spark)
    stream = spark.read.parquet(f"{base}/stream")
    assert stream.count() == 1 and stream.first().billing_level == "v1"
