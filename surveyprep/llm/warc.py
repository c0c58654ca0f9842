"""WARC archives: a Python data source that writes and reads per-record gzip files.

Every record is a gzip member of its own whose header carries the member's
compressed length (the ``sl`` extra field), so a reader can go from record to
record without inflating them. A read plans one partition per file (the
writer starts a new file at ``rollBytes``), inflates each record's headers
first, tests the pushed predicates on record type and headers, and skips the
payload of records that fail, or of all with ``payload`` set to false.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage)

from surveyprep.llm.common import Scratch, sized

#: Columns of the source and the headers that hold them.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest",
           "refers_to": "WARC-Refers-To", "payload_bytes": "X-Payload-Length", "page_id": "X-Page-ID"}
SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload_bytes long, page_id long, payload binary"
NUMBERS = {"payload_bytes", "page_id"}


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}") if not path.startswith("file:/") or path.startswith("file://") \
        else pafs.FileSystem.from_uri("file://" + path[5:])


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field holds its whole length and the length of its data."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def escaped(value) -> str:
    """A header value on one line: percent signs, controls and line ends as %XX."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 32 or ord(c) == 127 else c for c in str(value))


def unescaped(value: str) -> str:
    head, *rest = value.split("%")
    return head + "".join(chr(int(x[:2], 16)) + x[2:] for x in rest)


def record(values: dict, payload: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{HEADERS[k]}: {escaped(v)}" for k, v in values.items() if v is not None), f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


class Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Writes under _temporary; the driver's commit moves what the winning attempts wrote."""

    def __init__(self, path: str, roll: int):
        self.path, self.roll = path, roll

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Committed:
        fs, root = opened(self.path)
        fs.create_dir(f"{root}/_temporary")
        files, out = [], None
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None or out.tell() >= self.roll:
                        if out is not None:
                            out.close()
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        out = fs.open_output_stream(f"{root}/_temporary/{files[-1]}", compression=None)
                    payload = row.pop("payload") or b""
                    out.write(member(record({k: row[k] for k in HEADERS}, payload)))
        if out is not None:
            out.close()
        return Committed(files)

    def commit(self, messages: list) -> None:
        fs, root = opened(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.move(f"{root}/_temporary/{f}", f"{root}/{f}")
        if fs.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_temporary")

    def abort(self, messages: list) -> None:
        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_temporary")


class OneFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS or not isinstance(f, (EqualTo, In, IsNotNull)):
                yield f
            elif isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                self.tests.append((column, {f.value} if isinstance(f, EqualTo) else set(f.value)))

    def partitions(self) -> list[InputPartition]:
        fs, root = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return [OneFile(x.path) for x in sorted(found, key=lambda x: x.path) if x.path.endswith(".warc.gz")] or [OneFile("")]

    def read(self, partition: OneFile) -> Iterator[tuple]:
        if not partition.path:
            return
        fs, _ = opened(self.path)
        with fs.open_input_file(partition.path) as file:
            at, size = 0, file.size()
            while at < size:
                file.seek(at)
                head = file.read(24)
                if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"sl":
                    raise ValueError(f"{partition.path}: no record at byte {at}")
                total, length = struct.unpack("<II", head[16:24])
                body, inflate = b"", zlib.decompressobj(-15)
                left, text = total - 24, b""
                while b"\r\n\r\n" not in text:  # the headers first
                    body = inflate.unconsumed_tail or file.read(min(left, 4096))
                    left -= 0 if inflate.unconsumed_tail else len(body)
                    text += inflate.decompress(body, 2048)
                    if not body:
                        raise ValueError(f"{partition.path}: cut record at byte {at}")
                raw, _, start = text.partition(b"\r\n\r\n")
                got = dict(x.split(": ", 1) for x in raw.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in x)
                row = {c: unescaped(got[h]) if h in got else None for c, h in HEADERS.items()}
                row = {c: int(x) if c in NUMBERS and x is not None else x for c, x in row.items()}
                if all((row[c] is not None) if want is None else (row[c] in want) for c, want in self.tests):
                    payload = None
                    if self.payload:
                        rest = inflate.decompress(inflate.unconsumed_tail + file.read(left)) + inflate.flush()
                        payload = (start + rest)[:int(got["Content-Length"])]
                        if row["record_type"] == "response" and (row["payload_digest"] != sha1_base32(payload) or row["payload_bytes"] != len(payload)):
                            raise ValueError(f"{partition.path}: the payload at byte {at} isn't the one that was written")
                    yield (*row.values(), payload)
                at += total


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder); options: payload (true), rollBytes (128 MiB) for writes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("rollbytes", self.options.get("rollBytes", 128 << 20))))


@contextmanager
def pushdown(spark: SparkSession):
    """Filters reach Python data sources inside this block; the setting goes back after it."""
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def records(pages: DataFrame, scratch: Scratch, min_bytes: int = 0, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html") -> DataFrame:
    """The source's columns for each page: of equal payloads the largest page_id is the response."""
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(uri_col).alias("target_uri"), body.alias("body"))
    ids = scratch.cut(p.where("page_id is not null").select("page_id", F.sha1("body").alias("h"), F.octet_length("body").alias("b")).where(F.col("b") >= min_bytes), "ids")
    heads = ids.groupBy("h").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("hh"), "head")
    again = ids.join(heads, F.col("h") == F.col("hh")).where("page_id <> head").groupBy(F.col("page_id").alias("rid")).agg(F.max("head").alias("head"), F.max("h").alias("rh"))
    again = scratch.cut(again, "again")
    p = p.join(sized(again, 64), (F.col("page_id") == F.col("rid")) & (F.sha1("body") == F.col("rh")), "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    is_again = F.col("head").isNotNull()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([sha1_base32(x.as_py()) for x in b.column("body")], pa.string())], names=[*b.schema.names, "d"])

    p = p.select("page_id", "target_uri", "head", "body").mapInArrow(digests, "page_id long, target_uri string, head long, body binary, d string")
    return p.select(F.when(is_again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), urn(F.coalesce(F.col("page_id").cast("string"), F.lit("none"))).alias("record_id"),
                    "target_uri", F.col("d").alias("payload_digest"), F.when(is_again, urn(F.col("head"))).alias("refers_to"),
                    F.octet_length("body").cast("long").alias("payload_bytes"), "page_id", F.when(~is_again, F.col("body")).alias("payload"))


def archive_and_read(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Writes ``pages`` as WARC files in the shared folder and reads them back: the source's columns without payload.

    Response payloads are read and held against length and digest; revisits
    are read by their headers alone, through the pushed filter on the record
    type. Null payloads are empty; a null page_id is a response without id;
    of rows that repeat an id and a payload each is a record, and they are
    responses alike if theirs is the largest id. Null urls have no target.
    Other columns are not read. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    scratch = Scratch(spark, "warc")
    records(pages, scratch, min_bytes, **columns).write.format("warc").mode("append").save(scratch.path("archive"))
    with pushdown(spark):
        responses = scratch.cut(spark.read.format("warc").load(scratch.path("archive")).where("record_type = 'response'").drop("payload"), "responses")
        revisits = scratch.cut(spark.read.format("warc").option("payload", "false").load(scratch.path("archive")).where("record_type = 'revisit'").drop("payload"), "revisits")
    return responses.union(revisits)


# The digest's 40 hexadecimal digits are 8 groups of 5, each of them four characters of base 32.
OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
h AS (SELECT *, sha1(body) AS hex FROM p),
g AS (SELECT *, [CAST('0x' || substr(hex, 1 + 5 * i, 5) AS INTEGER) for i in range(8)] AS groups FROM h)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(groups[1 + j // 4] // CAST(pow(32, 3 - j % 4) AS INTEGER) % 32 AS INTEGER), 1) for j in range(32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""
