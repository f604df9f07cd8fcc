"""WARC archives as a PySpark Python data source.

Reading plans one partition per archive file. Filters on record type and on
header columns are pushed into the reader: it parses a record's headers, and if
they fail or the payload isn't asked for, it skips the rest without decoding.
Each record is a gzip member of its own that names its length in the ``sl``
(skip length) field of its header, so a skip is a seek. Plain archives are read
too; there a record's Content-Length does the same.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from jobweave.llm.common import stage
from jobweave.operators.dedup import marks
from jobweave.session import scratch_path, ship_package

# Rows of this schema are written; reading gives the same columns.
SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, payload binary"
)
ROLL_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
# What Spark hands to a Python worker at once; by rows alone, 10,000 payloads are held by the executor and the worker.
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
_HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
_WIRE = {v.lower(): k for k, v in _HEADERS.items()}
_WRAPPED = {"record_id", "refers_to"}
# An extension header names each column whose value is percent-encoded; in other values % stands for itself.
_ENCODED = "X-Percent-Encoded"
# A date is required in every record; archives here are made of tables, so it is fixed and files are reproducible.
_DATE = "2000-01-01T00:00:00Z"
_MEMBER_HEAD = 24
_ROWS = 64
_STEP = 1024
_SHORT = pa.schema(
    [(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "payload_digest", "refers_to")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def header_value(value: str) -> str:
    """A value that can't end its header line or lose its ends: others are percent-encoded, ``parse_head`` decodes them."""
    if value.isprintable() and value == value.strip():
        return value
    return quote(value, safe="".join(map(chr, range(33, 127))).replace("%", ""))


def record_bytes(row) -> bytes:
    """One record: WARC headers, HTTP headers, and for a response the payload."""
    payload = b"" if row["record_type"] == "revisit" else bytes(row["payload"] or b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Date: {_DATE}", "Content-Type: application/http; msgtype=response"]
    for column, name in _HEADERS.items():
        if (value := row[column]) is not None:
            written = f"<{value}>" if column in _WRAPPED else header_value(value)
            lines.append(f"{name}: {written}")
            if column not in _WRAPPED and written != value:
                lines.append(f"{_ENCODED}: {column}")
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(http) + len(payload)}")
    return b"".join(["\r\n".join(lines).encode(), b"\r\n\r\n", http, payload, b"\r\n\r\n"])


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member that holds ``data`` and its own length as a skip field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = _MEMBER_HEAD + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data) % 2**32)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) % 2**32)


def split_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own; the commit lists those that count in a manifest."""

    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = split_path(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        # Few rows at a time become Python objects.
        for row in (row for batch in batches for i in range(0, len(batch), _ROWS) for row in batch.slice(i, _ROWS).to_pylist()):
            if out is None or size >= ROLL_BYTES:
                if out is not None:
                    out.close()
                files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                out, size = system.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
            data = member(record_bytes(row))
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, root = split_path(self.path)
        system.create_dir(root, recursive=True)
        names = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{root}/manifest.txt") as out:
            out.write("\n".join(names).encode())

    def abort(self, messages) -> None:
        system, root = split_path(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                system.delete_file(f"{root}/{f}")


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: StructType):
        self.path, self.columns = path, columns.fieldNames()
        self.wanted: dict[str, set] = {}
        self.skipped: list[str] = []

    def pushFilters(self, filters: list[Filter]):
        """Take equality and membership tests on header columns; leave the others to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in _HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif column in ("record_id", "record_type") and isinstance(f, IsNotNull):
                continue  # every record has them
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        system, root = split_path(self.path)
        with system.open_input_stream(f"{root}/manifest.txt") as manifest:
            names = manifest.read().decode().split()
        return [WarcFile(f"{root}/{n}") for n in names]

    def read(self, partition: WarcFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without files
            return
        system, _ = split_path(self.path)
        held, size = [], 0
        schema = pa.schema([_SHORT.field(c) for c in self.columns])
        with system.open_input_file(partition.path) as raw:
            for row in read_records(io.BufferedReader(raw, 1 << 18), self.wanted, "payload" in self.columns):
                held.append([row.get(c) for c in self.columns])
                size += len(row.get("payload") or b"") + 500
                if size >= BATCH_BYTES:
                    yield _batch(held, schema)
                    held, size = [], 0
        if held:
            yield _batch(held, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def parse_head(lines: list[bytes]) -> tuple[dict, int]:
    """Columns and block length from the lines of a record's WARC headers."""
    if not lines or not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not the start of a WARC record: {lines[:1]!r}")
    row, length, encoded = {}, 0, []
    for line in lines[1:]:
        name, _, value = (x.strip() for x in line.decode().partition(":"))
        if name.lower() == "content-length":
            length = int(value)
        elif name.lower() == "content-type":
            row["http"] = value.startswith("application/http")
        elif name.lower() == _ENCODED.lower():
            encoded.append(value)
        elif column := _WIRE.get(name.lower()):
            row[column] = value[1:-1] if column in _WRAPPED else value
    return row | {c: unquote(row[c]) for c in encoded if c in row}, length


def http_length(lines: list[bytes]) -> int | None:
    """The entity length that HTTP headers give."""
    for line in lines:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    return None


def _two_ahead(stream: io.BufferedReader) -> bytes:
    """The next two bytes, which stay; one or none at the end. A peek gives a single byte if no more are buffered."""
    if len(start := stream.peek(2)[:2]) < 2:
        at = stream.tell()
        start = stream.read(2)
        stream.seek(at)
    return start


def read_records(stream: io.BufferedReader, wanted: dict[str, set], payload: bool) -> Iterator[dict]:
    """Records whose headers pass; ``payload`` says whether payloads are decoded or skipped."""
    while start := _two_ahead(stream):
        if start == b"\x1f\x8b":
            row = _read_member(stream, wanted, payload)
        elif start.strip():
            row = _read_plain(stream, wanted, payload)
        else:
            stream.readline()
            continue
        if row is not None:
            yield row


def _read_plain(stream: io.BufferedReader, wanted: dict[str, set], payload: bool) -> dict | None:
    until_blank = lambda: [*iter(lambda: stream.readline().rstrip(b"\r\n"), b"")]
    row, length = parse_head(until_blank())
    end, found = stream.tell() + length, None
    if all(row.get(c) in values for c, values in wanted.items()):
        found, row["payload_bytes"] = row, length
        if row.pop("http", False):
            row["payload_bytes"] = http_length(until_blank())
        if payload and row.get("record_type") != "revisit":
            row["payload"] = stream.read(end - stream.tell())
    stream.seek(end)
    return found


def _read_member(stream: io.BufferedReader, wanted: dict[str, set], payload: bool) -> dict | None:
    start = stream.tell()
    head = stream.read(_MEMBER_HEAD)
    if head[3] != 4 or head[12:14] != b"sl":
        raise ValueError("a compressed record without a skip length")
    end = start + struct.unpack_from("<I", head, 16)[0]
    inflate, data, found = zlib.decompressobj(-15), b"", None
    fed = 0  # compressed bytes given so far

    def more(least: int | None) -> bool:
        """Decode up to ``least`` further bytes, or everything."""
        nonlocal data, fed
        left = end - 8 - start - _MEMBER_HEAD - fed
        source = inflate.unconsumed_tail
        if not source and left:
            source = stream.read(left if least is None else min(least, left))
            fed += len(source)
        got = inflate.decompress(source, 0 if least is None else least) if source else b""
        data += got
        return bool(got) or left > 0 or bool(inflate.unconsumed_tail)

    def block(at: int) -> int:
        """Where the header block that starts at ``at`` ends."""
        while (stop := data.find(b"\r\n\r\n", at)) < 0 and more(_STEP):
            pass
        return stop

    stop = block(0)
    row, length = parse_head(data[:stop].split(b"\r\n"))
    if all(row.get(c) in values for c, values in wanted.items()):
        body = stop + 4
        found, row["payload_bytes"] = row, length
        if row.pop("http", False):
            stop = block(body)
            row["payload_bytes"] = http_length(data[body:stop].split(b"\r\n"))
            length -= stop + 4 - body
            body = stop + 4
        if payload and row.get("record_type") != "revisit":
            while len(data) < body + length and more(None):
                pass
            row["payload"] = data[body : body + length]
    stream.seek(end)
    return found


class WarcDataSource(DataSource):
    """``format("warc").option("path", folder)``; the columns read can be narrowed by a schema."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).option("path", path).load()


def base32_sha1(sha1_hex):
    """Bare upper-case base32 of a SHA-1 given in hex: four 40-bit groups of eight signs each."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    signs = []
    for group in range(4):
        number = F.conv(F.substring(sha1_hex, group * 10 + 1, 10), 16, 10).cast("long")
        for place in range(8):
            sign = F.shiftright(number, 35 - 5 * place).bitwiseAND(F.lit(31)).cast("int")
            signs.append(F.substring(alphabet, sign + 1, F.lit(1)))
    return F.concat(*signs)


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows of ``SCHEMA`` for pages: of those with equal payloads the smallest id is the response, others revisit it.

    Null html is an empty payload. A null id is written as ``none`` and revisits
    the smallest id of its payload; where all ids are null, all are responses.
    Rows that repeat the smallest id are responses too. A null url leaves the
    header out. Payloads are equal if SHA-1 and length are. Only payloads that
    surely or perhaps come again are shuffled; the pages are read twice more.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("target_uri"), body.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    # The digests travel; of a payload that a third of all pages have, each task sends one row.
    low = rows.groupBy("sha1", "payload_bytes").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1")
    low = stage(low.select("sha1", "payload_bytes", "low"), "warc-repeated")
    repeated = marks(low.select("sha1", "payload_bytes"))
    alone = F.lit(None).cast("long").alias("low")
    if repeated is None:
        first = rows.select("*", alone)
    else:
        again = repeated("sha1", "payload_bytes")
        joined = rows.filter(again).join(low, ["sha1", "payload_bytes"], "left")
        first = rows.filter(~again).select("*", alone).unionByName(joined)
    response = F.col("low").isNull() | F.coalesce(F.col("id") == F.col("low"), F.lit(False))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return first.select(
        urn(F.col("id")).alias("record_id"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha1:"), base32_sha1(F.col("sha1"))).alias("payload_digest"),
        F.when(~response, urn(F.col("low"))).alias("refers_to"),
        "payload_bytes",
        F.when(response, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str | None = None, **names: str) -> str:
    """Write the archive of ``pages`` and return its folder, by default a new one in the shared folder."""
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    before = spark.conf.get(_BATCHES, None)
    spark.conf.set(_BATCHES, str(BATCH_BYTES))
    try:
        page_records(pages, **names).write.format("warc").option("path", path).mode("append").save()
    finally:
        spark.conf.set(_BATCHES, before) if before is not None else spark.conf.unset(_BATCHES)
    return path


def page_of(urn):
    """The page id of a record's name; ``none`` is null."""
    return F.try_to_number(F.regexp_extract(urn, "^urn:page:(-?[0-9]+)$", 1), F.lit("S9999999999999999999")).cast("long")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archive, its length and digest taken from the payload itself where it is stored."""
    records = read_warc(spark, path)
    stored = F.col("payload").isNotNull()
    digest = F.when(stored, base32_sha1(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", ""))
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
