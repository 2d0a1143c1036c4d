"""Files read in byte ranges by a Python data source: lines, framed binary and members of zip archives.

A file is cut into ranges of `rangeBytes`; a task gets ranges until they make up that size, so neither a large file nor many
small ones weigh on one task, and no cell ever holds a file.  A record belongs to the range that its first byte lies in: a
line to that of its first character, a frame to that of its sync word, a member of an archive to that of its header.

Frames are found one after another: the search for a sync word goes on behind the frame before, so a sync word inside a
frame's data is none.  A range must know where its first search begins.  It looks back and follows the searches from every
byte that could be the beginning of one; all of them soon meet at one sync word, and from there on they are the same, so the
file's own search is among them.  Where they have not met before the range, it looks back twice as far, in the end from the
beginning of the file.

Files are reached by pyarrow (local, HDFS and the object stores it knows), so a task needs no JVM to read.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES, READ_BYTES, BATCH_ROWS = 64 << 20, 4 << 20, 1 << 16
#: What is read at once to find the end of a line.
LINE_BYTES = 1 << 12
#: Tasks that small ranges are dealt to, about; no task gets more than RANGE_BYTES so.
TASKS = 128


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if re.match(r"\w+://", path) else (fs.LocalFileSystem(), posixpath.abspath(path))


def listed(path: str) -> list[tuple[str, int]]:
    """Path and size of the files of a path: a file, a folder and all below it, or a mask of names in a folder."""
    system, inner = filesystem(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    folder, mask = posixpath.split(inner)
    if not re.search(r"[*?\[]", mask):
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [(prefix + info.path, info.size)]
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no such file or folder: {path}")
        folder, mask = inner, "*"
    found = system.get_file_info(fs.FileSelector(folder, recursive=folder == inner))
    hidden = re.compile(r"(^|/)[._]")
    kept = [x for x in found if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, mask) and not hidden.search(x.path[len(folder) :].lstrip("/"))]
    return sorted((prefix + x.path, x.size) for x in kept)


def write_bytes(path: str, content: bytes) -> None:
    system, inner = filesystem(path)
    system.create_dir(posixpath.dirname(inner), recursive=True)
    with system.open_output_stream(inner) as out:
        out.write(content)


@dataclass
class Ranges(InputPartition):
    """(path, first byte, byte after the last, size of the file) of each range of a task."""

    parts: list[tuple[str, int, int, int]]


def planned(files: list[tuple[str, int]], range_bytes: int) -> list[Ranges]:
    """Ranges of all files, dealt to tasks in order: as many to a task as make up a range, or its share of TASKS."""
    out, held = [[]], 0
    most = max(range_bytes, min(RANGE_BYTES, sum(size for _, size in files) // TASKS))
    for path, size in files:
        for begin in range(0, size, range_bytes):
            end = min(begin + range_bytes, size)
            if out[-1] and held + end - begin > most:
                out.append([])
                held = 0
            out[-1].append((path, begin, end, size))
            held += end - begin
    return [Ranges(x) for x in out if x]


def lines_of(file, begin: int, end: int, size: int, read_bytes: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """First byte and bytes of each line that begins in [begin, end), without line feed and carriage return."""
    at = begin
    if begin:
        # A line begins here if the byte before ends one; else go behind the next line feed.
        at = begin - 1
        while at < end:
            file.seek(at)
            chunk = file.read(min(read_bytes, size - at, LINE_BYTES))
            found = chunk.find(b"\n")
            if found >= 0:
                at += found + 1
                break
            at += len(chunk)
            if not chunk:
                return
    rest = b""
    file.seek(at)
    while at < end:
        # Of what lies behind the range only the end of its last line is read.
        chunk = file.read(min(read_bytes, max(end - at - len(rest), LINE_BYTES)))
        *whole, rest = (rest + chunk).split(b"\n") if chunk else ([rest, b""] if rest else [b""])
        for line in whole:
            if at >= end:
                return
            yield at, line.removesuffix(b"\r")
            at += len(line) + 1
        if not chunk:
            return


def frame_places(data: bytes, sync: bytes, length: int, start: int) -> Iterator[int]:
    """Places of the frames that the search beginning at `start` finds; length: bytes of a frame with its sync word."""
    at = data.find(sync, start)
    while at >= 0:
        yield at
        at = data.find(sync, at + length)


def first_search(file, begin: int, size: int, sync: bytes, length: int) -> int:
    """Where the file's own search for a sync word stands when it comes to `begin`: a place at or behind it, or a little before."""
    back = 4 * length
    while True:
        low = max(0, begin - back)
        file.seek(low)
        data = file.read(min(size, begin + length + len(sync)) - low)
        # No sync word begins before `none` where none is found.
        target, none = begin - low, max(begin - low, len(data) - len(sync) + 1)

        def after(start: int, data: bytes = data, none: int = none) -> int:
            found = data.find(sync, start)
            return found if found >= 0 else none

        # The search may stand at any of these bytes; those with the same next sync word are one.
        places = sorted({after(s) for s in (range(length + 1) if low else (0,))})
        # Follow all searches together, always the one furthest behind, until one is left.
        while places[0] < target and len(places) > 1:
            places = sorted({after(places[0] + length), *places[1:]})
        if len(places) == 1:
            at = places[0]
            while at < target:
                at += length
                if at < target:
                    at = after(at)
            return low + at
        back *= 2


def frames_of(file, begin: int, end: int, size: int, sync: bytes, words: int, dtype: str, read_bytes: int = READ_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of whole frames whose sync word begins in [begin, end), and their numbers (a row each)."""
    width = words * np.dtype(dtype).itemsize
    length = len(sync) + width
    at = first_search(file, begin, size, sync, length) if begin else 0
    while at < end:
        file.seek(at)
        data = file.read(min(read_bytes + length, size - at))
        last = len(data) - length
        places = []
        for p in frame_places(data, sync, length, 0):
            if p > last or at + p >= end:
                break
            places.append(p)
        if places:
            rows = np.frombuffer(b"".join(data[p + len(sync) : p + length] for p in places), dtype).reshape(-1, words)
            yield at + np.array(places, np.int64), rows
        # Go on behind the last frame; a sync word may lie across the end of what was read.
        ahead = max(places[-1] + length if places else 0, last + 1)
        found = data.find(sync, places[-1] + length if places else 0)
        at += min(ahead, found) if 0 <= found <= last else ahead
        if len(data) < length or at + length > size:
            return


def members_of(file, path: str, begin: int, end: int, pattern: str) -> Iterator[tuple[str, int, bytes]]:
    """Member, line number and line of the members of an archive whose headers begin in [begin, end), one line after another."""
    with zipfile.ZipFile(file) as archive:
        for info in archive.infolist():
            if begin <= info.header_offset < end and not info.is_dir() and re.search(pattern, info.filename):
                with archive.open(info) as member:
                    for number, line in enumerate(member, 1):
                        yield info.filename, number, line.rstrip(b"\r\n")


class RangeReader(DataSourceReader):
    """Reads the ranges of a task; `batches` makes Arrow batches of one of them."""

    def __init__(self, options: dict[str, str], batches) -> None:
        self.path, self.range_bytes, self.batches = options["path"], int(options.get("rangebytes", RANGE_BYTES)), batches

    def partitions(self) -> list[InputPartition]:
        return planned(listed(self.path), self.range_bytes)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for path, begin, end, size in partition.parts:
            system, inner = filesystem(path)
            with system.open_input_file(inner) as file:
                yield from self.batches(file, path, begin, end, size)


def batched(rows: Iterator, most: int = BATCH_ROWS) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield held
            held = []
    if held:
        yield held


class _Source(DataSource):
    """A source of ranges: options are those of the named format, and `rangeBytes`."""

    def option(self, name: str, default: str | None = None) -> str:
        value = self.options.get(name, default)
        if value is None:
            raise ValueError(f"format {self.name()} needs the option {name}")
        return value

    def reader(self, schema) -> RangeReader:
        return RangeReader(dict(self.options), self.batches(schema))


class Lines(_Source):
    """File, range, place (its first byte) and line of text files."""

    @classmethod
    def name(cls) -> str:
        return "line_ranges"

    def schema(self) -> str:
        return "file string, `range` bigint, place bigint, line string"

    def batches(self, schema):
        encoding = self.options.get("encoding", "utf-8")

        def run(file, path, begin, end, size):
            for rows in batched(lines_of(file, begin, end, size)):
                columns = [[path] * len(rows), [begin] * len(rows), [r[0] for r in rows], [r[1].decode(encoding, "replace") for r in rows]]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["file", "range", "place", "line"])

        return run


class Frames(_Source):
    """File, range, place and numbers of framed binary files.  Options: sync (hexadecimal), columns, dtype, sevenBit."""

    @classmethod
    def name(cls) -> str:
        return "frame_ranges"

    def schema(self) -> str:
        return "file string, `range` bigint, place bigint, " + ", ".join(f"`{c}` bigint" for c in self.option("columns").split(","))

    def batches(self, schema):
        sync, columns, dtype = bytes.fromhex(self.option("sync")), self.option("columns").split(","), self.options.get("dtype", "<i2")
        seven = self.options.get("sevenbit", "false").lower() == "true"
        if not sync:
            raise ValueError("an empty sync word")

        def run(file, path, begin, end, size):
            for places, rows in frames_of(file, begin, end, size, sync, len(columns), dtype):
                rows = (rows & 0x7F) | ((rows >> 8) & 0x7F) << 7 if seven else rows
                n = len(places)
                yield pa.record_batch([pa.array([path] * n), pa.array(np.full(n, begin)), pa.array(places), *(pa.array(np.ascontiguousarray(c).astype(np.int64)) for c in rows.T)], ["file", "range", "place", *columns])

        return run


class Members(_Source):
    """Archive, member, line_no and line of the members of zip archives.  Options: pattern (of the member's name)."""

    @classmethod
    def name(cls) -> str:
        return "zip_ranges"

    def schema(self) -> str:
        return "archive string, member string, line_no bigint, line string"

    def batches(self, schema):
        pattern = self.options.get("pattern", r"\.csv$")

        def run(file, path, begin, end, size):
            for rows in batched(members_of(file, path, begin, end, pattern)):
                columns = [[path] * len(rows), [r[0] for r in rows], [r[1] for r in rows], [r[2].decode("utf-8", "replace") for r in rows]]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], ["archive", "member", "line_no", "line"])

        return run


def register(spark: SparkSession, source: type[DataSource]) -> str:
    """Make a source known to the session; gives its name."""
    spark.dataSource.register(source)
    return source.name()
