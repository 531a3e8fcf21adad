"""Line files as an offset-tracked stream (S5, T1), without a message bus.

A folder of append-only text files (``.txt``, ``.log`` or no ending; names that
begin with ``_`` or ``.`` are left out) is read as a Python data source. The
stream's offset is the byte up to which each file was read, so Spark's own
checkpoint says where a restart goes on, in the middle of a file too. Only
whole lines count: a last line without its line feed waits until it has one.

``max_bytes`` bounds a micro-batch, as a bound on offsets does for a message
bus: files are taken in order of their names until the bound is used up; a
line longer than the bound comes alone. The planner is not told where the
stream stands, so with a bound it notes each offset that it gives out under
``progress``, one folder for one checkpoint. Should the driver die between the
note and Spark's own log, the next batch holds two bounds. A bounded stream
takes one bound for each trigger, so run it on a processing-time trigger.

The planner lists the folder and looks for line ends; the lines are read by
tasks, at most ``split_bytes`` each. A file that has shrunk raises an error;
one that was removed leaves the offset, so read files may go.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from encore.session import ship_package

FORMAT = "line_log"
SPLIT_BYTES = 64 << 20
_BLOCK = 4 << 20
#: Notes that are kept under ``progress``; the last whole one counts.
_NOTES = 3


@dataclass
class Slice(InputPartition):
    """Lines that begin in ``[lo, hi)`` of a file; ``first``: a line begins at ``lo``."""

    path: str
    lo: int
    hi: int
    first: bool


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; Hadoop's ``file:/x`` is ``file:///x``."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _is_log(name: str) -> bool:
    return name[:1] not in "._" and ("." not in name or name.endswith((".txt", ".log")))


def last_line_end(file, lo: int, size: int, budget: int | None) -> int:
    """The last line end in ``(lo, lo + budget]``; beyond it if the first line is longer; ``lo`` without one."""
    stop = size if budget is None else min(size, lo + budget)
    at = stop
    while at > lo:  # backwards to the last line end inside the budget
        begin = max(lo, at - _BLOCK)
        file.seek(begin)
        found = file.read(at - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        at = begin
    at = stop
    while at < size:  # the first line is longer than the budget
        file.seek(at)
        block = file.read(min(_BLOCK, size - at))
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return lo


class LineLogReader(DataSourceStreamReader):
    def __init__(self, path: str, max_bytes: int | None = None, progress: str | None = None,
                 split_bytes: int = SPLIT_BYTES):
        self.files, self.root = _opened(path)
        self.uri = path.rstrip("/")
        self.max_bytes, self.split_bytes = max_bytes, split_bytes
        self.given: dict[str, int] = {}
        self.notes = None
        if max_bytes is not None:
            self.note_files, self.notes = _opened(progress)
            self._recall()

    def _noted(self) -> list[int]:
        there = self.note_files.get_file_info(fs.FileSelector(self.notes, allow_not_found=True))
        return sorted(int(f.base_name) for f in there if f.base_name.isdigit())

    def _recall(self) -> None:
        for n in reversed(self._noted()):
            with self.note_files.open_input_file(f"{self.notes}/{n}") as f:
                raw = f.read()
            try:
                self.given = json.loads(raw)
                return
            except ValueError:  # cut short: that offset was never given out
                continue

    def _note(self) -> None:
        self.note_files.create_dir(self.notes, recursive=True)
        before = self._noted()
        with self.note_files.open_output_stream(f"{self.notes}/{before[-1] + 1 if before else 0}") as f:
            f.write(json.dumps(self.given).encode())
        for n in before[:1 - _NOTES]:
            self.note_files.delete_file(f"{self.notes}/{n}")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        there = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        sizes = {f.base_name: f.size for f in there if f.type == fs.FileType.File and _is_log(f.base_name)}
        left, out = self.max_bytes, {}
        for name in sorted(sizes):
            lo, size = self.given.get(name, 0), sizes[name]
            if size < lo:
                raise ValueError(f"{name} has shrunk from {lo} bytes to {size}: line logs only grow")
            out[name] = lo
            if size == lo or left is not None and left <= 0:
                continue
            with self.files.open_input_file(f"{self.root}/{name}") as f:
                end = last_line_end(f, lo, size, left)
                if left is not None and left < self.max_bytes and end - lo > left:
                    end = lo  # a long line comes alone, in a batch of its own
                    left = 0
            out[name] = end
            left = None if left is None else left - (end - lo)
        # A file of which no whole line was read has no place in the offset yet.
        out = {name: at for name, at in out.items() if at}
        if out != self.given:
            self.given = out
            if self.notes is not None:
                self._note()
        return out

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        out = []
        for name in sorted(end):
            lo, hi = start.get(name, 0), end[name]
            out += [Slice(f"{self.uri}/{name}", at, min(at + self.split_bytes, hi), at == lo)
                    for at in range(lo, hi, self.split_bytes)]
        return out

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        files, path = _opened(part.path)
        with files.open_input_file(path) as f:
            at, rest = part.lo, b""
            if not part.first:  # the line around lo is the slice's before, unless one ended there
                at = next_line(f, part.lo - 1)
            f.seek(at)
            while at < part.hi:
                block = f.read(min(_BLOCK, part.hi - at))
                if not block:
                    raise ValueError(f"{path} has shrunk below {part.hi} bytes")
                at += len(block)
                if at >= part.hi and not block.endswith(b"\n"):  # the last line goes on in the next slice
                    f.seek(at)
                    tail = next_line(f, at) - at
                    f.seek(at)
                    block += f.read(tail)
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        pass


def next_line(file, at: int) -> int:
    """The place after the first line feed at or after ``at``."""
    while True:
        file.seek(at)
        block = file.read(_BLOCK)
        if not block:
            return at
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LineLogReader:
        bound = self.options.get("maxBytes")
        return LineLogReader(self.options["path"], int(bound) if bound else None, self.options.get("progress"),
                             int(self.options.get("splitBytes", SPLIT_BYTES)))


def line_log(spark: SparkSession, path: str, max_bytes: int | None = None, progress: str | None = None,
             split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines (``value``) of the files in ``path``, as a stream."""
    ship_package(spark)
    spark.dataSource.register(LineLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("splitBytes", str(split_bytes))
    if max_bytes is not None:
        if not progress:
            raise ValueError("a bounded line log needs a folder for its progress")
        reader = reader.option("maxBytes", str(max_bytes)).option("progress", progress)
    return reader.load()
