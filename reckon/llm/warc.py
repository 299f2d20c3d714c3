"""WARC archives as a PySpark data source: ``spark.read.format("warc")``.

Reading: the driver plans partitions of whole files, filled to
``partitionBytes``; a task parses a record's headers first, tests the pushed
predicates on them, and only then touches the payload. Unwanted payloads are
neither inflated nor decoded: of compressed archives each record is a gzip
member, and its length stands in the member's ``sl`` extra field (a member
without the field is inflated and thrown away); plain archives are skipped by
the record's length.

Writing: each task attempt writes files of its own, cut at ``fileBytes``, and
the driver publishes those of the successful attempts in one commit file.
Readers open committed files only, so a lost executor leaves no half record
in sight. Files are reached through pyarrow's file systems, so a path may
name any store that these know.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from reckon.llm.common import ship_code
from reckon.session import cut_lineage, shared_dir

#: Columns that are header fields of a record.
FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type", "content_length": "content-length",
}
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, content_type string, content_length long, http_status int, payload_length long, headers map<string,string>, payload binary"
_ARROW = pa.schema([
    *((c, pa.int64() if c == "content_length" else pa.string()) for c in FIELDS),
    ("http_status", pa.int32()), ("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])

#: What a writer takes: ``headers`` are further header fields; a revisit's payload is measured, not written.
WRITE_COLUMNS = ("record_type", "record_id", "target_uri", "date", "refers_to", "headers", "payload")

#: Fixed values of the format.
VERSION, REVISIT_PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http; msgtype=response"
COMMITS = "_commits"

#: Bytes of files that one partition reads, of a file before the next is begun, and rows and payload bytes of a batch.
PARTITION_BYTES, FILE_BYTES, BATCH_ROWS, BATCH_BYTES = 128 << 20, 128 << 20, 2000, 16 << 20
_BUFFER, _HEAD, _MOST_HEAD = 1 << 18, 2048, 16 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" not in path:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


# --- records to bytes -------------------------------------------------------


def _field(value: str) -> bytes:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in value).strip().encode()


def encode_record(record_type: str, record_id: str, target_uri: str | None, date: str, refers_to: str | None, headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """One record. A response holds HTTP headers and the payload; a revisit the HTTP headers alone,
    with length and digest of the whole payload; any other type the bare payload."""
    fields = [("WARC-Type", record_type), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", target_uri)]
    if record_type in ("response", "revisit"):
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", refers_to)]
        fields += [("WARC-Profile", REVISIT_PROFILE)] if record_type == "revisit" else []
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        block, kind = block + payload if record_type == "response" else block, HTTP_RESPONSE
    else:
        block, kind = payload, "application/warc-fields" if record_type == "warcinfo" else "application/octet-stream"
    fields += [("Content-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = b"".join(name.encode() + b": " + _field(value) + b"\r\n" for name, value in fields if value is not None)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = 1) -> bytes:
    """A gzip member with its own and the record's length in the ``sl`` extra field (where they fit)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    size = 24 + len(body) + len(tail)
    if max(size, len(raw)) >> 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(raw)) + body + tail


# --- bytes to records -------------------------------------------------------


class _Plain:
    """A record of a plain file, from where ``f`` stands: bytes on demand."""

    def __init__(self, f: io.BufferedReader):
        self.f, self.start, self.held = f, f.tell(), b""

    def upto(self, n: int) -> bytes:
        if len(self.held) < n:
            self.held += self.f.read(n - len(self.held))
        return self.held

    def skip(self, n: int) -> None:
        """To the next record; this one has ``n`` bytes."""
        self.f.seek(self.start + n)


class _Gzip:
    """A record that is a gzip member."""

    def __init__(self, f: io.BufferedReader):
        self.f, self.start, self.size, self.held = f, f.tell(), None, b""
        head = f.read(10)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {self.start}")
        flags = head[3]
        if flags & 4:
            extra = f.read(struct.unpack("<H", f.read(2))[0])
            while len(extra) >= 4:
                name, n = struct.unpack_from("<2sH", extra)
                if name == b"sl" and n == 8:
                    self.size = struct.unpack_from("<I", extra, 4)[0]
                extra = extra[4 + n :]
        for bit in (8, 16):  # file name, comment
            while flags & bit and f.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            f.read(2)
        self.z, self.crc, self.n = zlib.decompressobj(-15), 0, 0

    def _more(self, n: int) -> bytes:
        """About ``n`` further bytes of the record, none at its end."""
        while not self.z.eof:
            data = self.z.unconsumed_tail or self.f.read(max(512, n // 3))
            if not data:
                raise ValueError(f"gzip member at byte {self.start} is cut short")
            out = self.z.decompress(data, n)
            self.crc, self.n = zlib.crc32(out, self.crc), self.n + len(out)
            if out:
                return out
        return b""

    def upto(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and (more := self._more(n - have)):
            parts.append(more)
            have += len(more)
        self.held = b"".join(parts)
        return self.held

    def skip(self, n: int) -> None:
        if self.size is not None:
            self.f.seek(self.start + self.size)
            return
        while self._more(1 << 16):
            pass
        if self.z.unused_data:
            self.f.seek(-len(self.z.unused_data), io.SEEK_CUR)
        if struct.unpack("<II", self.f.read(8)) != (self.crc, self.n & 0xFFFFFFFF):
            raise ValueError(f"gzip member at byte {self.start}: wrong checksum")


def _block(record, at: int) -> int:
    """Where the header block that begins at byte ``at`` ends."""
    n = at + _HEAD
    while True:
        raw = record.upto(n)
        end = raw.find(b"\r\n\r\n", at)
        if end >= 0:
            return end + 4
        if len(raw) < n or n > _MOST_HEAD:
            return -1
        n *= 2


def _headers(raw: bytes) -> dict[str, str]:
    """Fields by lower-case name; lines that begin with a blank continue the one before; repeated fields are joined by commas."""
    out: dict[str, str] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def _first(f: io.BufferedReader) -> bytes:
    """The two bytes from where ``f`` stands, fewer at its end only (``peek`` gives one where the buffer holds one)."""
    first = f.read(2)
    f.seek(-len(first), io.SEEK_CUR)
    return first


def read_records(f: io.BufferedReader, wanted: Callable[[dict[str, str]], bool], payloads: bool) -> Iterator[tuple]:
    """Rows (in the order of SCHEMA) of the records of a file whose headers are ``wanted``."""
    while True:
        first = _first(f)
        if not first:
            return
        record = _Gzip(f) if first == b"\x1f\x8b" else _Plain(f)
        if not record.upto(1):  # an empty member
            record.skip(0)
            continue
        end = _block(record, 0)
        if end < 0 or not record.held.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {record.start}")
        head = _headers(record.held[:end])
        if not head.get("content-length", "").isdecimal():
            raise ValueError(f"record at byte {record.start} has no valid Content-Length")
        length = int(head["content-length"])
        whole = end + length + 4
        if wanted(head):
            status, at, full = None, end, length
            if head.get("content-type", "").startswith("application/http") and length:
                http = _block(record, end)
                if 0 <= http <= end + length:
                    line = record.held[end:http].split(b"\r\n", 1)[0].split()
                    status = int(line[1]) if line[0].startswith(b"HTTP/") and len(line) > 1 and line[1].isdigit() else None
                    told = _headers(record.held[end:http]).get("content-length", "")
                    at, full = http, end + length - http
                    if head.get("warc-type") == "revisit" and told.isdigit():
                        full = int(told)
            payload = None
            if payloads:
                if len(record.upto(end + length)) < end + length:
                    raise ValueError(f"record at byte {record.start} is cut short")
                payload = record.held[at : end + length]
            yield (*(length if c == "content_length" else head.get(k) for c, k in FIELDS.items()), status, full, list(head.items()), payload)
        record.skip(whole)


# --- the data source --------------------------------------------------------

_COMPARE = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b,
    StringStartsWith: lambda a, b: a.startswith(b), StringEndsWith: lambda a, b: a.endswith(b), StringContains: lambda a, b: b in a,
}


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child)
    if type(f) in (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual):  # strings compare by bytes in Spark
        return f.attribute == ("content_length",)
    return type(f) in (*_COMPARE, EqualNullSafe, IsNull, IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in FIELDS


def _holds(f: Filter, head: dict[str, str]) -> bool | None:
    """A filter on a record's headers, None for SQL's unknown."""
    if isinstance(f, Not):
        inner = _holds(f.child, head)
        return None if inner is None else not inner
    column = f.attribute[0]
    value = head.get(FIELDS[column])
    if column == "content_length":
        value = int(value) if (value or "").isdecimal() else None
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None or f.value is None:
        return None
    if isinstance(f, In) and None in f.value and value not in f.value:
        return None
    return _COMPARE[type(f)](value, f.value)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.most = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, by path, filled to ``partitionBytes``."""
        out, held, size = [], [], 0
        for name, n in committed(self.path):
            if held and size + n > self.most:
                out.append(Files(tuple(held)))
                held, size = [], 0
            held.append(name)
            size += n
        return [*out, Files(tuple(held))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as native, io.BufferedReader(native, _BUFFER) as f:
                records = read_records(f, lambda head: all(_holds(x, head) is True for x in self.filters), self.payloads)
                while True:
                    try:
                        row = next(records, None)
                    except ValueError as e:
                        raise ValueError(f"{path}: {e}") from e
                    if row is None:
                        break
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _table(rows)
                        rows, size = [], 0
        if rows:
            yield _table(rows)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def committed(path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the archive's files: those of its commits, or all
    *.warc and *.warc.gz below a folder that has none; a file is itself."""
    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    commits = [i for i in fs.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True)) if i.path.endswith(".json")]
    if commits:
        told = {}
        for c in commits:
            with fs.open_input_stream(c.path) as f:
                told[posixpath.basename(c.path)] = json.loads(f.read())
        gone = {name for t in told.values() for name in t["replaces"]}
        return sorted((f"{root}/{name}", n) for c, t in told.items() if c not in gone for name, n in t["files"])
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((i.path, i.size) for i in found if i.type == pafs.FileType.File and i.path.endswith((".warc", ".warc.gz")) and not posixpath.basename(i.path).startswith(("_", ".")))


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = str(options.get("compression", "gzip")).lower() != "none"
        self.most = int(options.get("filebytes", options.get("fileBytes", FILE_BYTES)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        attempt, done, f = uuid.uuid4().hex, [], None
        coded = gzip_member if self.gzip else bytes
        for b in iterator:
            for record in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in WRITE_COLUMNS)):
                if f is None:
                    name, size = f"{attempt}-{len(done):05d}.warc{'.gz' if self.gzip else ''}", 0
                    f = fs.open_output_stream(f"{root}/{name}", compression=None)
                    info = encode_record("warcinfo", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", None, record[3], None, [], b"format: WARC File Format 1.1\r\n")
                    size += f.write(coded(info))
                kind, ident, uri, date, refers, headers, payload = record
                size += f.write(coded(encode_record(kind, ident, uri, date, refers, headers or [], payload or b"")))
                if size >= self.most:
                    f.close()
                    done.append((name, size))
                    f = None
        if f is not None:
            f.close()
            done.append((name, size))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        """The files of all successful attempts become visible at once, when the commit file gets its
        name; an overwrite names the commits that it replaces."""
        fs, root = filesystem(self.path)
        fs.create_dir(f"{root}/{COMMITS}", recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}")) if i.path.endswith(".json")] if self.overwrite else []
        name = f"{root}/{COMMITS}/{uuid.uuid4().hex}"
        with fs.open_output_stream(name) as f:
            f.write(json.dumps({"files": [x for m in messages if m for x in m.files], "replaces": [posixpath.basename(x) for x in old]}).encode())
        fs.move(name, f"{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """Options: ``path``; for reading ``payload`` (false: headers alone, payloads are null) and ``partitionBytes``;
    for writing ``compression`` (gzip or none) and ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if missing := set(WRITE_COLUMNS) - set(schema.names):
            raise ValueError(f"columns missing: {sorted(missing)}")
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``format("warc")`` known to the session, with filters pushed to it."""
    ship_code(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # the source has pushFilters, which Spark refuses otherwise
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``, columns as in SCHEMA.

    Spark 4.1 plans a query that has no filter to push with the filters of the query before it on
    the same frame. A predicate that holds for every record (a length is mandatory) is therefore always pushed."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path).filter("content_length >= 0")


# --- pages to archives and back ---------------------------------------------

#: Copies of a payload meet its first record in so many parts.
SALTS = 16
#: The date of all records, as pages have none: equal pages give equal archives.
DATE = "1970-01-01T00:00:00Z"


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with _file and _at, the place of each row in the files that it reads. Where the plan is
    more than a scan, so that rows may share a place, it is written first."""
    nodes = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    if any(line.lstrip(" +-:").split(" ")[0].split("[")[0] not in ("Project", "Filter", "Relation") for line in nodes if line):
        df = cut_lineage(df)
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def _urn(file: Column, at: Column) -> Column:
    """A record id from the row's place."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws(":", at, file)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> None:
    """Writes each page as a record. Of equal payloads of ``min_bytes`` or more, the row with
    the largest id is a response, and the others are revisits that refer to it; null ids come
    before all others, and of repeated rows the last one in the files is the response. Smaller
    payloads are responses all. Null payloads are empty; null URLs and ids leave their field out."""
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = _numbered(rows).withColumn("key", F.sha2("payload", 256))
    of = F.struct("id", F.col("_file").alias("file"), F.col("_at").alias("at"))
    first = rows.filter(F.length("payload") >= min_bytes).groupBy("key").agg(F.max(of).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("_file", "_at"), F.lit(SALTS)).cast("int")).join(first, ["key", "salt"], "left")
    again = F.col("first").isNotNull() & ~((F.col("first.file") == F.col("_file")) & (F.col("first.at") == F.col("_at")))
    known = F.map_filter(
        F.create_map(F.lit("X-Page-Id"), F.col("id").cast("string"), F.lit("X-Refers-To-Page-Id"), F.when(again, F.col("first.id").cast("string"))),
        lambda _, v: v.isNotNull(),
    )
    records = rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), _urn(F.col("_file"), F.col("_at")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(DATE).alias("date"), F.when(again, _urn(F.col("first.file"), F.col("first.at"))).alias("refers_to"),
        known.alias("headers"), "payload",
    )
    records.write.format("warc").mode("append").save(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the pages in an archive, from
    the headers alone; no payload is inflated."""
    met = read_warc(spark, path, payload=False).filter(F.col("record_type").isin("response", "revisit"))
    return met.select(
        F.col("headers")["x-page-id"].cast("long").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        F.col("headers")["x-refers-to-page-id"].cast("long").alias("refers_to"),
    )


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back: ``page_records``, one
    row per page. No pages give no rows."""
    path = f"{shared_dir(pages.sparkSession).rstrip('/')}/reckon-warc/{uuid.uuid4().hex}"
    write_pages(pages, path, min_bytes)
    return page_records(pages.sparkSession, path)
