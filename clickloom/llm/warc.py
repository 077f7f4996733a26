"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing. Every row becomes one record in its own gzip member; a task writes one file after another,
each up to ``maxBytes``. A file has a name of its own per attempt, and every commit writes a manifest
of its own that names the files of the attempts that counted, so retried or lost tasks leave nothing
that is read; the reader reads what all manifests name. The gzip header of a member holds its compressed length.

Reading. The driver lists files and packs them into partitions by size. Comparisons with a
constant (equality, membership, prefix, null tests) on record type and header columns are taken
over by the source, so Spark does not see the other records. Headers are parsed first: a record
that fails a predicate, or whose payload column is not asked for, is passed over by its length,
without inflating or decoding the rest of it. Archives of other writers lack that length and are
inflated member by member, or read without compression; their payloads are treated alike.

Input columns of the writer (missing ones are left out of the record): ``record_type``
("response", "revisit" or another type), ``page_id``, ``target_uri``, ``date``, ``refers_to``
(page), ``payload_digest``, ``payload_bytes`` and ``payload`` (binary).

Defined results: a missing payload is empty; line breaks in header values are written as blanks;
equal rows make equal records; an empty table makes an empty archive, which reads as no rows.
Broken records end the file with an error that names it. Columns beyond those listed are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = """record_type string, record_id string, page_id long, target_uri string, date string,
    refers_to long, payload_digest string, payload_bytes long, payload binary"""

# Names of header fields, and the profile of revisit records.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "page_id": "X-Page-ID",
    "refers_to": "X-Refers-To-Page-ID",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST = "sha256:"
NUMBERS = {"page_id", "refers_to"}
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<HccH", 8, b"s", b"l", 4)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, reached the same way from driver and executors."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _member(data: bytes, level: int) -> bytes:
    """A gzip member that states its own length in an extra field."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return GZIP_HEAD + struct.pack("<I", len(GZIP_HEAD) + 4 + len(body) + 8) + body + tail


def _line(name: str, value: object) -> str:
    return f"{name}: {' '.join(str(value).split())}\r\n"


def encode_record(row: dict) -> bytes:
    """The bytes of one record."""
    kind = row.get("record_type") or "resource"
    payload = row.get("payload") or b""
    size = row.get("payload_bytes")
    http = b""
    if kind in ("response", "revisit"):
        http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload) if size is None else size}\r\n\r\n").encode()
    if kind == "revisit":
        payload = b""
    name = f"{row.get('page_id')} {row.get('payload_digest')} {row.get('target_uri')}"
    head = "WARC/1.1\r\n" + _line("WARC-Type", kind)
    head += _line("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>")
    head += _line("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z")
    for column in ("page_id", "target_uri", "refers_to"):
        if row.get(column) is not None:
            head += _line(FIELDS[column], row[column])
    if row.get("payload_digest"):
        head += _line(FIELDS["payload_digest"], DIGEST + row["payload_digest"])
    if kind == "revisit":
        head += _line("WARC-Profile", PROFILE)
    head += "Content-Type: " + ("application/http; msgtype=response" if http else "text/html") + "\r\n"
    head += f"Content-Length: {len(http) + len(payload)}\r\n\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("maxbytes", 256 << 20))
        self.level = int(options.get("level", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.limit:
                        if out is not None:
                            out.close()
                        files.append(f"part-{number:05d}-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                    member = _member(encode_record(row), self.level)
                    out.write(member)
                    size += len(member)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        names = sorted(f for m in messages if m for f in m.files)
        with system.open_output_stream(f"{folder}/manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _open(self.path)
        for name in (f for m in messages if m for f in m.files):
            system.delete_file(f"{folder}/{name}")


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns = schema.names
        self.schema = schema
        self.path = options["path"].rstrip("/")
        self.target = int(options.get("partitionbytes", 64 << 20))
        self.batch = int(options.get("batchrows", 500))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _pushable(f):
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, folder = _open(self.path)
        info = system.get_file_info(fs.FileSelector(folder))
        sizes = {i.base_name: i.size for i in info if i.type == fs.FileType.File
                 and i.base_name.endswith((".warc", ".warc.gz"))}
        manifests = [i.base_name for i in info if re.fullmatch(r"manifest(-[0-9a-f]{32})?\.json", i.base_name)]
        if manifests:
            counted: set[str] = set()
            for name in manifests:
                with system.open_input_stream(f"{folder}/{name}", compression=None) as f:
                    counted.update(json.loads(f.read()))
            sizes = {name: sizes[name] for name in sorted(counted)}
        groups, room = [], 0
        for name in sorted(sizes, key=sizes.get, reverse=True):
            if sizes[name] > room:
                groups.append([])
                room = self.target
            groups[-1].append(name)
            room -= sizes[name]
        return [Files(g) for g in groups or [[]]]  # no files are one empty partition

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, folder = _open(self.path)
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in self.schema])
        rows, held = [], 0
        for name in partition.names:
            with system.open_input_file(f"{folder}/{name}") as file:
                for row in _records(file, name, self.wanted, "payload" in self.columns):
                    rows.append({c: row.get(c) for c in self.columns})
                    held += len(row.get("payload") or b"")
                    if len(rows) >= self.batch or held >= 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    def wanted(self, row: dict) -> bool:
        return all(_holds(f, row) for f in self.tests)


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child)
    known = isinstance(f, EqualTo | EqualNullSafe | In | IsNull | IsNotNull | StringStartsWith)
    return known and len(f.attribute) == 1 and f.attribute[0] in FIELDS


def _holds(f: Filter, row: dict) -> bool | None:
    """The filter's value for a record's header; None is SQL's unknown and so not true."""
    if isinstance(f, Not):
        inner = _holds(f.child, row)
        return None if inner is None else not inner
    have = row.get(f.attribute[0])
    if isinstance(f, IsNull):
        return have is None
    if isinstance(f, IsNotNull):
        return have is not None
    if isinstance(f, EqualNullSafe):
        return have == f.value
    if have is None or (isinstance(f, EqualTo | StringStartsWith) and f.value is None):
        return None
    if isinstance(f, EqualTo):
        return have == f.value
    if isinstance(f, In):
        return True if have in f.value else None if None in f.value else False
    return have.startswith(f.value)


def parse_head(head: bytes) -> dict:
    """The columns that a record's header states, and its ``content_length``."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    stated = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        stated[name.strip().lower()] = value.strip()
    row: dict = {c: stated.get(name.lower()) for c, name in FIELDS.items()}
    for c in NUMBERS:
        row[c] = int(row[c]) if row[c] is not None else None
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix(DIGEST)
    row["content_length"] = int(stated.get("content-length", 0))
    row["http"] = stated.get("content-type", "").startswith("application/http")
    return row


def _records(file, name: str, wanted, payloads: bool) -> Iterator[dict]:
    start, size = 0, file.size()
    while start < size:
        file.seek(start)
        first = file.read(min(4096, size - start))
        if first[:2] == b"\x1f\x8b":
            known = struct.unpack_from("<I", first, 16)[0] if first[:16] == GZIP_HEAD else None
            row, block, start = _gzip_record(file, name, start, first, known, wanted, payloads)
        else:
            head, start = _plain_head(file, name, start, first)
            row = parse_head(head)
            block = None
            if wanted(row):
                file.seek(start)
                need = row["content_length"] if payloads else min(row["content_length"], 4096)
                block = file.read(need)
            start += row["content_length"] + 4
        if block is not None:
            _add_payload(row, block, payloads)
            yield row


def _plain_head(file, name: str, start: int, first: bytes) -> tuple[bytes, int]:
    data = first
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = file.read(4096)
        if not more:
            raise ValueError(f"{name}: record at byte {start} has no end of header")
        data += more
    return data[:end], start + end + 4


def _gzip_record(file, name, start, data, known, wanted, payloads):
    """One member: its header, its block if wanted, and where the next member starts."""
    inflate = zlib.decompressobj(31)
    out, fed = b"", 0
    # the header alone first
    while b"\r\n\r\n" not in out:
        if not data and not inflate.unconsumed_tail:
            raise ValueError(f"{name}: member at byte {start} has no end of header")
        fed += len(data)
        out += inflate.decompress(inflate.unconsumed_tail + data, 1024)
        data = b"" if inflate.unconsumed_tail else file.read(65536)
    end = out.index(b"\r\n\r\n")
    row = parse_head(out[:end])
    take = wanted(row)
    if known and (not take or not payloads):
        need = min(row["content_length"], 512)
        while take and len(out) < end + 4 + need and not inflate.eof:
            fed += len(data)
            more = inflate.decompress(inflate.unconsumed_tail + data, 1024)
            data = b"" if inflate.unconsumed_tail else file.read(65536)
            if not more and not data and not inflate.unconsumed_tail:
                break
            out += more
        return row, out[end + 4:end + 4 + need] if take else None, start + known
    parts = [out]
    while not inflate.eof:
        fed += len(data)
        chunk = inflate.decompress(inflate.unconsumed_tail + data)
        if take:
            parts.append(chunk)
        if inflate.eof:
            break
        data = file.read(1 << 20)
        if not data:
            raise ValueError(f"{name}: member at byte {start} is cut off")
    block = b"".join(parts)[end + 4:end + 4 + row["content_length"]] if take else None
    return row, block, start + fed - len(inflate.unused_data)


def _add_payload(row: dict, block: bytes, payloads: bool) -> None:
    size, body = row["content_length"], 0
    if row["http"]:
        cut = block.find(b"\r\n\r\n")
        body = cut + 4 if cut >= 0 else 0
        size -= body
        for line in block[:max(cut, 0)].decode("latin-1").split("\r\n"):
            if line.lower().startswith("content-length:"):
                size = int(line.split(":")[1])
    row["payload_bytes"] = size
    if payloads and row["record_type"] != "revisit":
        row["payload"] = block[body:]


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take over predicates."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


LEAST_BYTES = 100  # smaller payloads are never written as revisits


def records(pages: DataFrame, html: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Input rows of the writer: of equal payloads of at least ``least`` bytes, the one with the
    smallest ``page_id`` is the response, the others revisit it.

    First places are found on digests alone. Only digests that occur twice or more come back to the
    pages; that table is broadcast by Spark if it is small, and otherwise a page's row is shuffled
    once, where a digest with very many pages can be split. Repeated rows with the smallest
    ``page_id`` are all responses; so are rows without a ``page_id`` if no other row has one.
    """
    cells = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        (F.col("url").cast("string") if "url" in pages.columns else F.lit(None)).alias("target_uri"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    cells = cells.withColumns({"payload_digest": F.sha2("payload", 256),
                               "payload_bytes": F.octet_length("payload").cast("long")})
    first = (cells.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    later = F.col("first").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return cells.join(first, "payload_digest", "left").select(
        F.when(later, "revisit").otherwise("response").alias("record_type"),
        "page_id", "target_uri", F.when(later, F.col("first")).alias("refers_to"),
        "payload_digest", "payload_bytes",
        F.when(~later | F.col("first").isNull(), F.col("payload")).alias("payload"))


def write_archive(pages: DataFrame, path: str, html: str = "html") -> None:
    register(pages.sparkSession)
    records(pages, html).write.format("warc").option("path", path).mode("append").save()


def read_archive(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records of an archive; name fewer columns in ``schema`` to leave payloads undecoded."""
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)
