"""WARC archives as a Spark data source (operator 9).

``register(spark)`` adds the format ``warc``:

* Writing: each task writes gzip files of one member per record, rolled over at
  ``max_file_bytes``.  Each member's gzip header carries its compressed length
  (the ``sl`` extra field), so a reader can step over a record without
  inflating it.  The driver's commit writes the list of committed files;
  files of failed or repeated tasks are in no list and are never read.
* Reading: files are grouped into partitions by size.  Filters on the record
  type and on header columns are pushed into the reader, which parses headers
  first: a record that fails them is skipped without decoding its payload, as
  is any payload when the schema asked for has no ``payload`` column.

``archive_pages`` writes one record per page: of pages with equal payloads the
one with the largest key is a response, the others revisit records that name
it.  Only digests and keys are grouped; a digest that holds a third of all
pages is combined map-side, and the join back is a plain equi-join that Spark
may split.

Defined cases: a null payload is empty; a null key is written as an empty
record number and read as null, and is a response only if no equal payload has
a key; rows with the largest key and equal payloads are all responses; the
format's columns are selected by name, others are ignored; empty tables give an
empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from martkit.llm.common import scratch_path, table

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
VERSION = b"WARC/1.1\r\n"
NAMES = {  # fixed values: header names of the columns
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
HEADER_COLUMNS = [*NAMES, "payload_bytes"]
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COMPARE = {
    EqualTo: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    StringStartsWith: lambda a, b: a.startswith(b),
}


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split("\r")).replace("\n", " ")


def encode_record(record: dict, date: str) -> bytes:
    """One record, uncompressed."""
    payload = record["payload"] or b""
    revisit = record["record_type"] == "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    digest = record.get("payload_digest") or base32_sha1(payload)
    head = [
        f"WARC-Type: {record['record_type']}",
        f"WARC-Record-ID: <{_clean(record['record_id'])}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(record['target_uri'] or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{_clean(record['refers_to'] or '')}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int) -> bytes:
    """The record as one gzip member whose extra field ``sl`` holds the member's
    compressed and the record's plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 12 + 12 + len(body) + len(tail)
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict):
        self.path, self.level = path, int(options.get("level", 3))
        self.limit = int(options.get("max_file_bytes", 256 << 20))
        self.date = options.get("date", "2000-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.path)
        files: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None or size > self.limit:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                member = gzip_member(encode_record(record, self.date), self.level)
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, root = filesystem(self.path)
        names = [name for m in messages if m is not None for name in m.files]
        with store.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        store, root = filesystem(self.path)
        for m in messages:
            for name in m.files if m is not None else []:
                store.delete_file(f"{root}/{name}")


class Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict):
        self.path, self.columns = path, schema.fieldNames()
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.wanted: list = []

    def pushFilters(self, filters):
        for f in filters:
            column = getattr(f, "attribute", ("",))
            if type(f) in COMPARE and len(column) == 1 and column[0] in HEADER_COLUMNS:
                self.wanted.append((type(f), column[0], f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = filesystem(self.path)
        found = {i.base_name: i for i in store.get_file_info(pafs.FileSelector(root)) if i.is_file}
        lists = [n for n in found if n.startswith("_committed-")]
        names = sorted(n for n in found if n.endswith((".warc", ".warc.gz")))
        if lists:  # written by this format: only what was committed
            held: set[str] = set()
            for n in lists:
                with store.open_input_stream(found[n].path, compression=None) as f:
                    held.update(json.loads(f.read()))
            names = [n for n in names if n in held]
        groups: list[list[str]] = []
        size = 0
        for n in names:
            if not groups or size + found[n].size > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(found[n].path)
            size += found[n].size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        rows, held = [], 0
        for path in partition.files:
            with store.open_input_file(path) as f:
                records = _gzip_records(f) if path.endswith(".gz") else _plain_records(f)
                for head, body in records:
                    row = self._row(head, body)
                    if row is not None:
                        rows.append(row)
                        held += len(row.get("payload") or b"") + 200
                    if held > 8 << 20:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _row(self, head: dict, body) -> dict | None:
        """The record's columns, or None if a pushed filter fails; ``body()``
        decodes the block and is called only when the block is needed."""
        row = {}
        for column, name in NAMES.items():
            value = head.get(name.lower())
            if value is not None and column in ("record_id", "refers_to"):
                value = value.removeprefix("<").removesuffix(">")
            if value is not None and column == "payload_digest":
                value = value.removeprefix("sha1:")
            row[column] = value
        sized = any(c == "payload_bytes" for _, c, _ in self.wanted)
        for kind, column, value in self.wanted:
            if column != "payload_bytes" and (row[column] is None or not COMPARE[kind](row[column], value)):
                return None
        response = row["record_type"] == "response"
        need = "payload" in self.columns or self.verify
        if need and response:
            block = body(None)
        elif "payload_bytes" in self.columns or sized:
            block = body(4096)  # the HTTP header names the length
        else:
            return row
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(
            (int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None
        )
        row["payload_bytes"] = length
        for kind, column, value in self.wanted:
            if column == "payload_bytes" and (length is None or not COMPARE[kind](length, value)):
                return None
        if need and response:
            row["payload"] = payload
            if self.verify and (base32_sha1(payload) != row["payload_digest"] or len(payload) != length):
                raise ValueError(f"record {row['record_id']}: the payload is not what its header says")
        return row

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, kinds.get(c, pa.string())) for c in self.columns])
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(c) for r in rows], schema.field(c).type) for c in self.columns], schema=schema
        )


def parse_head(raw: bytes) -> dict:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _gzip_records(f):
    """(header, block reader) of each gzip member.  A member with the ``sl``
    field is stepped over by its length, others by inflating them."""
    at = 0
    size = f.size()
    while at < size:
        start = f.read_at(24, at)
        length = None
        if start[3] & 4 and start[12:14] == b"sl":
            length = struct.unpack("<I", start[16:20])[0]
        member = _Member(f, at, length)
        head, _, _ = member.until(b"\r\n\r\n")
        fields = parse_head(head)
        yield fields, lambda most, m=member, n=int(fields.get("content-length", 0)): m.block(n, most)
        at = at + length if length else member.end()


class _Member:
    """Inflates one gzip member piece by piece."""

    STEP = 16 << 10

    def __init__(self, f, at: int, length: int | None):
        self.f, self.at, self.stop = f, at, at + length if length else f.size()
        self.inflater, self.plain = zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.inflater.eof or self.at >= self.stop:
            return False
        raw = self.f.read_at(min(self.STEP, self.stop - self.at), self.at)
        self.at += len(raw)
        self.plain += self.inflater.decompress(raw)
        return True

    def until(self, mark: bytes) -> tuple[bytes, bytes, bytes]:
        while mark not in self.plain and self.more():
            pass
        head, found, rest = self.plain.partition(mark)
        self.start = len(head) + len(found)
        return head, found, rest

    def block(self, n: int, most: int | None) -> bytes:
        upto = self.start + (n if most is None else min(n, most))
        pieces, held = [self.plain], len(self.plain)
        self.plain = b""
        while held < upto and self.more():
            pieces.append(self.plain)
            held += len(self.plain)
            self.plain = b""
        self.plain = b"".join(pieces)
        return self.plain[self.start : upto]

    def end(self) -> int:
        while not self.inflater.eof and self.more():
            self.plain = b""
        return self.at - len(self.inflater.unused_data)


def _plain_records(f):
    """Records of an uncompressed file: blocks are stepped over by their length."""
    at, size = 0, f.size()
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head and at + len(head) < size:
            head += f.read_at(4096, at + len(head))
        raw = head.partition(b"\r\n\r\n")[0]
        fields = parse_head(raw)
        start, n = at + len(raw) + 4, int(fields.get("content-length", 0))
        yield fields, lambda most, s=start, n=n: f.read_at(n if most is None else min(n, most), s)
        at = start + n + 4


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder")
        store, root = filesystem(self.options["path"])
        store.create_dir(root, recursive=True)
        return WarcWriter(self.options["path"], dict(self.options))


def register(spark: SparkSession) -> None:
    """Add the format ``warc`` to the session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_pages(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", min_bytes: int = 0,
) -> None:
    """Write one record per page; equal payloads of at least ``min_bytes`` once."""
    register(pages.sparkSession)
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("k"), F.col(uri).alias("uri"), body.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    equal = (
        rows.where(F.col("size") >= min_bytes)
        .groupBy("sha", "size")
        .agg(F.max("k").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("sha", "size", "first")
    )
    marked = rows.join(equal, ["sha", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first"))
    number = lambda c: F.concat(F.lit("urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    records = marked.select(
        number("k").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.coalesce("uri", F.lit("")).alias("target_uri"),
        F.when(revisit, number("first")).alias("refers_to"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.col("size").cast("long").alias("payload_bytes"),
        "payload",
    )
    records.write.format("warc").mode("append").option("path", path).save()


def read_archive(spark: SparkSession, path: str, payload: bool = False, verify: bool = False) -> DataFrame:
    """Records of a folder of archives; without ``payload`` none is returned,
    and with ``verify`` each response's payload is held against its header."""
    register(spark)
    columns = SCHEMA if payload else SCHEMA.rpartition(", ")[0]
    return spark.read.format("warc").schema(columns).option("verify", str(verify).lower()).load(path)


def q_op9(spark, sf_dir):
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    archive_pages(pages, path)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.nullif(F.substring_index(F.col(c), ":", -1), F.lit("")).cast(kind)
    return read_archive(spark, path, verify=True).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648 alphabet
QUERIES = {"op9_warc": q_op9}
ORACLE_SQL = {
    "op9_warc": f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
), coded AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i:
    substr('{BASE32}', 1 + CAST(substr(array_to_string(list_transform(range(40), lambda j:
      right(lpad(bin(CAST('0x' || substr(h, j + 1, 1) AS INTEGER)), 4, '0'), 4)), ''), 5 * i + 1, 1) AS INTEGER) * 16
    + CAST(substr(array_to_string(list_transform(range(40), lambda j:
      right(lpad(bin(CAST('0x' || substr(h, j + 1, 1) AS INTEGER)), 4, '0'), 4)), ''), 5 * i + 2, 1) AS INTEGER) * 8
    + CAST(substr(array_to_string(list_transform(range(40), lambda j:
      right(lpad(bin(CAST('0x' || substr(h, j + 1, 1) AS INTEGER)), 4, '0'), 4)), ''), 5 * i + 3, 1) AS INTEGER) * 4
    + CAST(substr(array_to_string(list_transform(range(40), lambda j:
      right(lpad(bin(CAST('0x' || substr(h, j + 1, 1) AS INTEGER)), 4, '0'), 4)), ''), 5 * i + 4, 1) AS INTEGER) * 2
    + CAST(substr(array_to_string(list_transform(range(40), lambda j:
      right(lpad(bin(CAST('0x' || substr(h, j + 1, 1) AS INTEGER)), 4, '0'), 4)), ''), 5 * i + 5, 1) AS INTEGER), 1)), '')
    AS payload_digest
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded
"""
}
