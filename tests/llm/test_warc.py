"""WARC archives: exact round trips, pushed predicates, foreign and broken files."""

import base64
import gzip
import hashlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

from reckon.llm import warc
from reckon.llm.registry import ORACLE, op13_warc

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a/1", "same", "k"), (2, None, "same", "k"), (2, "http://a/2b", "same", "k"), (None, "http://a/\r\nWARC-Type: evil", None, "k"), (5, "http://é/", "", "k"),
    (7, "http://b/7", "x" * 3_000_000 + "\r\n\r\nWARC/1.1\r\n", "k"), (8, "http://b/8", "Ünï😀\0end", None), (None, None, "orphan", "k"), (None, None, "orphan", "k"),
]


@pytest.fixture(scope="module")
def pages(spark):
    """Nulls in every column, an empty and a long payload, ties, repeated rows, extra columns with names the operator uses."""
    return spark.createDataFrame([(*r[:3], r[3], 1) for r in PAGES], "page_id long, url string, html string, key string, salt int")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    best = {}
    for i, t in rows:
        best.setdefault(t or "", []).append(-1 if i is None else i)
    out = []
    for t, ids in best.items():
        ids.sort()
        small = len(t.encode()) < least
        for k, i in enumerate(ids):
            again = not small and k < len(ids) - 1
            out.append((None if i < 0 else i, len(t.encode()), digest(t), "revisit" if again else "response", ids[-1] if again and ids[-1] >= 0 else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_against_brute_force(pages, least):
    got = sorted(map(tuple, warc.warc_round_trip(pages, least).collect()), key=str)
    assert got == brute([r[0:3:2] for r in PAGES], least)


def test_query_matches_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = duck.sql(ORACLE["op13_warc"])
    got = op13_warc(spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_payloads_and_headers(spark, pages, tmp_path, compression):
    warc.register(spark)
    rows = pages.select(F.lit("response").alias("record_type"), F.concat(F.lit("<urn:x:"), F.coalesce("page_id", F.lit(0)), F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"),
                        F.lit(warc.DATE).alias("date"), F.lit(None).cast("string").alias("refers_to"), F.create_map(F.lit("X-Own"), "key").alias("headers"), F.col("html").cast("binary").alias("payload"))
    for k in range(2):  # a second write is added, an overwrite replaces both
        rows.write.format("warc").option("compression", compression).option("fileBytes", 100).mode("append").save(str(tmp_path))
    back = warc.read_warc(spark, str(tmp_path)).filter("record_type = 'response'")
    assert sorted(bytes(r.payload) for r in back.collect()) == sorted([(r[2] or "").encode() for r in PAGES] * 2)
    assert all(r.payload_digest == "sha1:" + digest(bytes(r.payload).decode()) and r.payload_length == len(r.payload) and r.http_status == 200 for r in back.collect())
    assert "evil" not in {r.record_type for r in warc.read_warc(spark, str(tmp_path)).select("record_type").collect()}
    rows.limit(1).write.format("warc").option("compression", compression).mode("overwrite").save(str(tmp_path))
    assert warc.read_warc(spark, str(tmp_path)).filter("record_type = 'response'").count() == 1


def test_predicates_reach_the_source(spark, pages, tmp_path):
    warc.write_pages(pages, str(tmp_path))
    read = warc.read_warc(spark, str(tmp_path), payload=False)
    everything = read.collect()
    for text, keep in (
        ("record_type = 'revisit'", lambda r: r.record_type == "revisit"),
        ("record_type in ('response', 'x') and target_uri like 'http://b/%'", lambda r: r.record_type == "response" and (r.target_uri or "").startswith("http://b/")),
        ("target_uri is null", lambda r: r.target_uri is None),
        ("not target_uri = 'http://a/1'", lambda r: r.target_uri not in (None, "http://a/1")),
        ("content_length > 1000 and http_status = 200", lambda r: r.content_length > 1000),
        ("refers_to is not null or record_type = 'warcinfo'", lambda r: r.refers_to is not None or r.record_type == "warcinfo"),
    ):
        met = read.filter(text)
        assert sorted(r.record_id for r in met.collect()) == sorted(r.record_id for r in everything if keep(r)), text
        assert read.count() == len(everything)  # a filter stays with its own query
    # what is pushed is not tested again by Spark
    assert "Filter (" not in spark._jvm.PythonSQLUtils.explainString(read.filter("record_type = 'revisit'")._jdf.queryExecution(), "simple")
    plain = warc.WarcReader({"path": str(tmp_path), "payload": "false"})
    assert list(plain.pushFilters([warc.EqualTo(("http_status",), 200), warc.EqualTo(("record_type",), "revisit")])) == [warc.EqualTo(("http_status",), 200)]


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    """Of a member with the skip length, only the head is inflated, also where the payload is damaged."""
    big = warc.encode_record("response", "<urn:x:1>", "u", warc.DATE, None, [], bytes(range(256)) * 40_000)
    member = bytearray(warc.gzip_member(big))
    member[len(member) // 2] ^= 255
    small = warc.gzip_member(warc.encode_record("resource", "<urn:x:2>", "u", warc.DATE, None, [], b"tail"))
    f = io.BufferedReader(io.BytesIO(bytes(member) + small))
    got = list(warc.read_records(f, lambda head: head["warc-type"] == "resource", True))
    assert [r[-1] for r in got] == [b"tail"]


@pytest.mark.parametrize("coded", [warc.gzip_member, gzip.compress, bytes])
def test_records_begin_anywhere_in_the_buffer(tmp_path, monkeypatch, coded):
    """Also where the buffer holds one more byte, of a gzip member's two."""
    payloads = [b"".join(hashlib.sha256(b"%d,%d" % (k, j)).digest() for j in range(300 + k)) for k in range(3)]
    members = [coded(warc.encode_record("response", f"<urn:x:{k}>", "u", warc.DATE, None, [], p)) for k, p in enumerate(payloads)]
    path = str(tmp_path / "a.warc.gz")
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    for own in ("true", "false"):
        reader = warc.WarcReader({"path": path, "payload": own})
        for size in range(len(members[0]) - 2, len(members[0]) + 3):
            monkeypatch.setattr(warc, "_BUFFER", size)
            rows = [r for b in reader.read(warc.Files((path,))) for r in b.to_pylist()]
            assert [(r["record_id"], r["payload_length"], r["payload"]) for r in rows] == [(f"<urn:x:{k}>", len(p), p if own == "true" else None) for k, p in enumerate(payloads)], size


def test_foreign_archives(spark, tmp_path):
    """Members without a skip length, folded and repeated fields, several records in plain files, no commits."""
    records = [
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:1>\r\nX-A: one\r\n two\r\nx-a: three\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n",
        b"WARC/1.0\r\nwarc-type:request\r\nWARC-Record-ID:<urn:x:2>\r\nContent-Type: application/http; msgtype=request\r\nContent-Length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:x:3>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "notes.txt").write_text("no archive")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload)) for r in got) == sorted([("resource", b"hello"), ("request", b""), ("metadata", b"")] * 2)
    assert {r.headers["x-a"] for r in got if r.record_type == "resource"} == {"one two, three"}
    assert {r.record_id for r in warc.read_warc(spark, str(tmp_path), payload=False).filter("record_type <> 'request'").collect()} == {"<urn:x:1>", "<urn:x:3>"}
    (tmp_path / "c.warc").write_bytes(records[0][:-30])
    with pytest.raises(Exception, match="c.warc"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_empty_tables(spark, pages, tmp_path):
    assert warc.warc_round_trip(pages.limit(0)).collect() == []
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id int, url string, html string")).collect() == []


def test_partitions_are_whole_files(tmp_path):
    for k in range(10):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * 40)
    parts = warc.WarcReader({"path": str(tmp_path), "partitionbytes": "100"}).partitions()
    assert sorted(len(p.paths) for p in parts) == [2] * 5 and len({x for p in parts for x in p.paths}) == 10
