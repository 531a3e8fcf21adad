"""WARC archives as a PySpark Python data source (operator 1).

Writing: each task writes gzip members, one per record, to files of its own;
the commit lists the files of successful tasks in a manifest, so files of
lost or doubled tasks are never read. A member's gzip header states its
length (extra field ``WL``), which lets a reader leap over it.

Reading: files are planned into partitions by size. Equality and set filters
on the header columns are pushed down. Each record's headers are parsed first;
a record that a filter rejects is left without decoding its payload, and with
option ``payload=false`` no payload is decoded at all. Plain ``.warc`` and
foreign ``.warc.gz`` files are read too.

Defined cases: a null payload is empty; a null page_id is written as ``null``
and never becomes what others refer to; of rows that repeat the smallest
page_id all are responses; a null url is left out; other columns of ``pages``
are ignored; an empty table gives an archive without records.
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
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage,
)

from encore.session import scratch_path

from .tables import opaque

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_length long, content_type string, headers map<string,string>, payload binary")
_ARROW = pa.schema([(n, pa.string()) for n in ("record_type", "record_id", "target_uri", "refers_to",
                                               "payload_digest")]
                   + [("payload_length", pa.int64()), ("content_type", pa.string()),
                      ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
#: Columns on which filters are pushed down, and the headers they stand for.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
FILE_BYTES = 64 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
#: Payloads below this size are always stored, as revisits would save nothing.
LEAST_BYTES = 100
_MANIFEST = "_committed.json"


def filesystem(path: str):
    from pyarrow import fs
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def member(record: bytes) -> bytes:
    """A gzip member whose header states its whole length."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(record) + pack.flush()
    size = 10 + 2 + 8 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHI", 8, b"WL", 4, size) + body
            + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record: a response with an HTTP head and the payload, or a revisit with the head alone."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row[
        "payload_length"]
    block = head if revisit else head + payload
    lines = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"),
             ("WARC-Date", "1970-01-01T00:00:00Z"),
             ("WARC-Target-URI", row["target_uri"] and _clean(row["target_uri"])),
             ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
             ("WARC-Refers-To", row["refers_to"] and f"<{row['refers_to']}>"),
             ("Content-Type", "application/http; msgtype=response"), ("X-Payload-Length", row["payload_length"]),
             ("Content-Length", len(block))]
    text = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    return b"WARC/1.1\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = member(record({n: batch.column(n)[i].as_py() for n in batch.schema.names}))
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{_MANIFEST}") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages: list) -> None:
        store, root = filesystem(self.path)
        for m in messages:
            for name in m.files if m else ():
                store.delete_file(f"{root}/{name}")


@dataclass
class Files(InputPartition):
    paths: list[str]


class _Stream:
    """Bytes of a file with a look ahead and leaps."""

    def __init__(self, file):
        self.file, self.held = file, b""

    def peek(self, n: int) -> bytes:
        if len(self.held) < n:
            self.held += self.file.read(max(n - len(self.held), 1 << 18))
        return self.held[:n]

    def take(self, n: int) -> bytes:
        got = self.peek(n)
        self.held = self.held[len(got):]
        return got

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.file.seek(n - len(self.held), 1)
            self.held = b""


def _parsed(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name:
            out.setdefault(name.strip().lower(), value.strip())
    return out


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((name, frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In):
                self.wanted.append((name, frozenset(f.value)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs
        store, root = filesystem(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=False))
        listed = next((f for f in found if f.base_name == _MANIFEST), None)
        if listed:
            with store.open_input_stream(listed.path) as f:
                names = set(json.loads(f.read()))
        infos = sorted((f for f in found if (f.base_name in names if listed else re.search(r"\.warc(\.gz)?$", f.path))),
                       key=lambda f: f.path)
        out, size = [], PARTITION_BYTES
        for f in infos:
            if size + f.size > PARTITION_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out or [Files([])]

    def accepts(self, row: dict) -> bool:
        return all(row[name] in values for name, values in self.wanted)

    def _row(self, head: bytes) -> dict:
        headers = _parsed(head)
        row = {c: headers.get(h) for c, h in HEADERS.items()}
        for c in ("record_id", "refers_to", "target_uri"):
            if row[c] and row[c][0] == "<" and row[c][-1] == ">":
                row[c] = row[c][1:-1]
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha256:")
        stated = headers.get("x-payload-length", "")
        row["payload_length"] = int(stated) if stated.isdigit() else None
        row["headers"] = list(headers.items())
        row["_block"] = int(headers.get("content-length", 0))
        return row

    def _payload(self, row: dict, block: bytes) -> bytes | None:
        if row["record_type"] == "revisit":
            return None
        if (row["content_type"] or "").startswith("application/http"):
            return block.partition(b"\r\n\r\n")[2]
        return block

    def _plain(self, s: _Stream) -> Iterator[dict]:
        while True:
            while s.peek(2) == b"\r\n":
                s.skip(2)
            n = 4096
            while b"\r\n\r\n" not in (head := s.peek(n)):
                if len(head) < n:
                    return
                n *= 2
            head = head.partition(b"\r\n\r\n")[0]
            s.skip(len(head) + 4)
            row = self._row(head)
            if not self.accepts(row):
                s.skip(row["_block"])
                continue
            if self.payload:
                row["payload"] = self._payload(row, s.take(row["_block"]))
            else:
                s.skip(row["_block"])
            yield row

    def _members(self, s: _Stream) -> Iterator[dict]:
        while len(start := s.peek(20)) >= 18:
            length = None
            if start[3] == 4 and start[12:14] == b"WL":
                length = struct.unpack("<I", start[16:20])[0]
            unpack = zlib.decompressobj(31)
            head, feed, used = b"", b"", 0
            while b"\r\n\r\n" not in head and not unpack.eof:
                if not feed:
                    feed = s.peek(used + 2048)[used:][:2048]
                    used += len(feed)
                    if not feed:
                        return
                head += unpack.decompress(feed, 2048)
                feed = b"" if unpack.eof else unpack.unconsumed_tail
            text, _, block = head.partition(b"\r\n\r\n")
            row = self._row(text)
            wanted = self.accepts(row)
            need = wanted and self.payload
            if length is None or need:
                # Without a stated length the member's end shows only when all is unpacked.
                parts, left = [block], feed
                while not unpack.eof:
                    if not left:
                        left = s.peek(used + 65536)[used:]
                        used += len(left)
                        if not left:
                            break
                    got = unpack.decompress(left, 1 << 20)
                    left = b"" if unpack.eof else unpack.unconsumed_tail
                    if need:
                        parts.append(got)
                if length is None:
                    length = used - len(left) - len(unpack.unused_data)
                block = b"".join(parts)
            s.skip(length)
            if wanted:
                if self.payload:
                    row["payload"] = self._payload(row, block[:row["_block"]])
                yield row

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                s = _Stream(file)
                for row in self._members(s) if s.peek(2) == b"\x1f\x8b" else self._plain(s):
                    del row["_block"]
                    rows.append(row)
                    size += 500 + len(row.get("payload") or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").option("payload", "false").load(path)`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive_rows(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records to write for ``pages`` (page_id, url, html): equal payloads are stored once."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("payload"), F.sha2(body, 256).alias("digest"))
    large = F.octet_length("payload") >= least_bytes
    first = (rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select(F.concat(F.col("digest"), F.lit("#")).alias("key"), "first"))
    # '#' makes the key opaque: both sides are plain shuffles, and AQE splits a hot payload.
    met = rows.withColumn("mine", F.when(large, F.concat(F.col("digest"), F.lit("#")))).join(
        first, F.col("mine") == F.col("key"), "left")
    revisit = F.coalesce(F.col("first") < F.col("page_id"), F.lit(False))

    def urn(c: str):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))

    return met.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"), F.when(revisit, urn("first")).alias("refers_to"),
        F.col("digest").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` and digests what is read back, by page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(archive_rows(pages), path)
    page = F.expr("try_cast(substring(record_id, 10) as long)").alias("page_id")
    shared = [F.col("record_type"), F.expr("try_cast(substring(refers_to, 10) as long)").alias("refers_to")]
    stored = read(spark, path).filter("record_type = 'response'").select(
        page, F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), *shared)
    # Revisits carry no payload: headers alone tell all about them.
    again = read(spark, path, payload=False).filter("record_type = 'revisit'").select(
        page, F.col("payload_length").alias("payload_bytes"), "payload_digest", *shared)
    return stored.unionAll(again)
