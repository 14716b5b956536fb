"""Log directory as a data source, in batch and as a growing stream.

Every row is one line with its file name and the byte position where it starts.
Batch and stream give the same rows, so a backfill and a tail agree on positions.

The built-in text source does not notice text appended to a file it has seen. Here
the stream offset is the length of every file, and a task reads one byte range. A
line belongs to the range holding its line end; the reader looks back for its
start. So a last line still being written waits for its line end, or until the file
has rested for ``lastLineAfterSeconds``; ranges of one file are read in parallel
without any exchange between them.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "loglines"
PRODUCER_FILES = r"^output[0-9]+\.log$"

_SCHEMA = "file_name string, pos bigint, value string"
_LINE_END = b"\n"
_HEAD = 256
_TAIL = 256
_READERS = 16
_LOOK_BACK = 1 << 16


@dataclass
class ByteRange(InputPartition):
    path: str
    file_name: str
    start: int
    stop: int
    to_end: bool
    fresh: bool = False


@dataclass(frozen=True)
class _Settings:
    path: str
    names: str
    split_bytes: int
    chunk_bytes: int
    trigger_bytes: int
    max_ranges: int
    last_line_after: float
    checkpoint: str | None = None
    source_index: int = 0

    @classmethod
    def of(cls, options: dict[str, str]) -> _Settings:
        def size(name: str, default: int) -> int:
            return int(options.get(name, default))

        return cls(
            path=options["path"],
            names=options.get("filenameregex", options.get("fileNameRegex", ".*")),
            split_bytes=size("splitBytes", 64 << 20),
            chunk_bytes=size("chunkBytes", 4 << 20),
            trigger_bytes=size("maxBytesPerTrigger", 0),
            max_ranges=size("maxRanges", 100_000),
            last_line_after=float(options.get("lastLineAfterSeconds", 60)),
            checkpoint=options.get("checkpointLocation"),
            source_index=size("sourceIndex", 0),
        )


def _listing(path: str, names: str) -> list[pafs.FileInfo]:
    """Regular files directly in the folder, by name; none if it is missing."""
    system, inner = pafs.FileSystem.from_uri(path)
    infos = system.get_file_info(pafs.FileSelector(inner, recursive=False, allow_not_found=True))
    wanted = re.compile(names)
    found = [i for i in infos if i.type == pafs.FileType.File and wanted.search(i.base_name)]
    return sorted(found, key=lambda i: i.base_name)


@dataclass(frozen=True)
class _Part:
    """Bytes of a file to read. ``to_end``: a last line without line end counts;
    ``fresh``: the line before ``start`` has been read, though it had no line end."""

    name: str
    start: int
    stop: int
    to_end: bool = False
    fresh: bool = False


def _plan(settings: _Settings, parts: list[_Part]) -> list[ByteRange]:
    """Byte ranges of the parts. Ranges grow with the whole, so that their number,
    which the driver holds, stays bounded; a task streams its range in chunks
    whatever its size."""
    whole = sum(part.stop - part.start for part in parts)
    step = max(settings.split_bytes, -(-whole // settings.max_ranges))
    folder = settings.path.rstrip("/")
    found = []
    for part in parts:
        starts = list(range(part.start, part.stop, step)) or ([part.start] if part.to_end else [])
        for at in starts:
            last = at + step >= part.stop
            fresh = part.fresh and at == part.start
            found.append(ByteRange(f"{folder}/{part.name}", part.name, at, min(at + step, part.stop), part.to_end and last, fresh))
    return found


def _line_start(source: pa.NativeFile, at: int) -> int:
    """Start of the line that the byte before ``at`` belongs to or ends."""
    while at > 0:
        lo = max(0, at - _LOOK_BACK)
        found = source.read_at(at - lo, lo).rfind(_LINE_END)
        if found >= 0:
            return lo + found + 1
        at = lo
    return 0


def _batch(name: str, first: int, block: bytes) -> pa.RecordBatch:
    """Lines of a block that ends with a line end."""
    data = np.frombuffer(block, dtype=np.uint8)
    ends = np.flatnonzero(data == _LINE_END[0])
    starts = np.append(0, ends[:-1] + 1) + first
    try:
        block.decode("utf-8")
    except UnicodeDecodeError:
        lines = pa.array(block.decode("utf-8", errors="replace").split("\n")[:-1], pa.string())
    else:  # the bytes between line ends lie side by side: no line becomes a Python string
        offsets = np.append(0, ends - np.arange(len(ends))).astype(np.int32)
        kept = data[data != _LINE_END[0]]
        lines = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(kept))
    if b"\r\n" in block:
        lines = pc.replace_substring_regex(lines, r"\r\z", "")
    return pa.RecordBatch.from_arrays(
        [pa.repeat(name, len(lines)), pa.array(starts, pa.int64()), lines],
        names=["file_name", "pos", "value"],
    )


def _blocks(part: ByteRange, chunk_bytes: int) -> Iterator[tuple[int, bytes]]:
    """Whole lines of a range with the position of the first, in blocks of about ``chunk_bytes``."""
    system, inner = pafs.FileSystem.from_uri(part.path)
    with system.open_input_file(inner) as source:
        at = part.start
        if part.fresh:
            first = at = at + (source.read_at(1, at) == _LINE_END)
        else:
            first = _line_start(source, at)
        held = [source.read_at(at - first, first)] if first < at else []
        while at < part.stop:
            chunk = source.read_at(min(chunk_bytes, part.stop - at), at)
            if not chunk:
                break
            at += len(chunk)
            cut = chunk.rfind(_LINE_END) + 1
            if not cut:
                held.append(chunk)
                continue
            block = b"".join([*held, chunk[:cut]])
            yield first, block
            first += len(block)
            held = [chunk[cut:]] if cut < len(chunk) else []
        rest = b"".join(held)
        if part.to_end and rest:
            yield first, rest + _LINE_END


def _read(part: ByteRange, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    for first, block in _blocks(part, chunk_bytes):
        yield _batch(part.file_name, first, block)


class _LinesReader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self.settings = settings

    def partitions(self) -> list[ByteRange]:
        infos = _listing(self.settings.path, self.settings.names)
        return _plan(self.settings, [_Part(info.base_name, 0, info.size, to_end=True) for info in infos])

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes when there is nothing to read
            return iter(())
        return _read(partition, self.settings.chunk_bytes)


def _last_offset(checkpoint: str, source_index: int) -> dict | None:
    """The newest offset of a source in a query's checkpoint: where the query stands, whether
    or not its batch was finished, as a batch that was not is run again up to there.

    ``{}`` if the query has no batch yet; None if the offset is not to be read.
    """
    system, inner = pafs.FileSystem.from_uri(checkpoint)
    folder = pafs.FileSelector(f"{inner.rstrip('/')}/offsets", recursive=False, allow_not_found=True)
    batches = [int(info.base_name) for info in system.get_file_info(folder) if info.base_name.isdigit()]
    if not batches:
        return {}
    with system.open_input_stream(f"{folder.base_dir}/{max(batches)}") as source:
        version, _, *offsets = source.read().decode().split("\n")
    if version != "v1" or source_index >= len(offsets):
        return None
    try:
        found = json.loads(offsets[source_index])
    except ValueError:  # a source without offset yet
        return {}
    return found if isinstance(found, dict) else None


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()[:16]


class _LinesStream(DataSourceStreamReader):
    """Offset: per file its read length, marks of its first line and of the bytes
    before the read length, and whether a last line without line end was released.

    A file that got shorter, or whose first line or bytes before the read length
    changed, was replaced and is read from its start.
    """

    def __init__(self, settings: _Settings):
        self.settings = settings
        self.seen: dict[tuple, tuple[object, str]] = {}
        self.known: dict | None = None

    def _marked(self, name: str, start: int, size: int, shorten: Callable[[bytes], bytes | None]) -> str:
        system, inner = pafs.FileSystem.from_uri(f"{self.settings.path.rstrip('/')}/{name}")
        with system.open_input_file(inner) as source:
            data = shorten(source.read_at(size, start))
        return "" if data is None else _digest(data)

    def _cached(self, key: tuple, version: object, make: Callable[[], str]) -> str:
        found = self.seen.get(key)
        if not found or found[0] != version:
            found = self.seen[key] = (version, make())
        return found[1]

    def _head(self, info: pafs.FileInfo) -> str:
        def line(data: bytes) -> bytes | None:
            first, end, _ = data.partition(_LINE_END)
            return first if end or len(data) == _HEAD else None

        version = (info.mtime_ns, info.size)
        return self._cached(
            (info.base_name, "head"), version, lambda: self._marked(info.base_name, 0, min(_HEAD, info.size), line)
        )

    def _tail(self, name: str, end: int) -> str:
        start = max(0, end - _TAIL)
        return self._marked(name, start, end - start, bytes)

    def _open_line(self, info: pafs.FileInfo) -> bool:
        """Whether a file that has rested long enough ends without a line end."""
        rested = time.time_ns() - (info.mtime_ns or 0) >= self.settings.last_line_after * 1e9
        return rested and self._marked(info.base_name, info.size - 1, 1, bytes) != _digest(_LINE_END)

    @staticmethod
    def _from(start: dict, name: str, entry: dict) -> int:
        before = start.get(name)
        if before and before["mark"] == entry["mark"] and before["end"] <= entry["end"]:
            return before["end"]
        return 0

    def initialOffset(self) -> dict:
        self.known = {}
        return {}

    def latestOffset(self) -> dict:
        infos = [info for info in _listing(self.settings.path, self.settings.names) if info.size]
        with ThreadPoolExecutor(_READERS) as readers:
            heads = readers.map(self._head, infos)
            now = {i.base_name: {"end": i.size, "mark": mark} for i, mark in zip(infos, heads, strict=True)}
            # Spark asks for the latest offset before it tells where a query stands. A new
            # query stands at the start; a restarted one is found in its checkpoint. Without
            # that the first batch after a start takes all that is waiting, as byte ranges read in
            # parallel, like a batch job.
            if self.settings.trigger_bytes and self.known is None and self.settings.checkpoint:
                self.known = _last_offset(self.settings.checkpoint, self.settings.source_index)
            if self.settings.trigger_bytes and self.known is not None:
                grown = [n for n, e in now.items() if self._from(self.known, n, e) < e["end"]]
                share = max(1, self.settings.trigger_bytes // max(1, len(grown)))
                for name in grown:
                    now[name]["end"] = min(now[name]["end"], self._from(self.known, name, now[name]) + share)

            def finish(info: pafs.FileInfo) -> None:
                entry, version = now[info.base_name], (info.mtime_ns, info.size)
                key = (info.base_name, entry["end"])
                entry["tail"] = self._cached(key, version, lambda: self._tail(*key))
                entry["closed"] = entry["end"] == info.size and self._open_line(info)

            list(readers.map(finish, infos))
        self.seen = {key: found for key, found in self.seen.items() if key[1] == "head" or key[1] == now.get(key[0], {}).get("end")}
        self.known = now
        return now

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.known = end

        def part(name: str) -> _Part | None:
            entry, before = end[name], start.get(name, {})
            begin = self._from(start, name, entry)
            if begin and "tail" in before and entry.get("tail") != before["tail"] and self._tail(name, begin) != before["tail"]:
                begin, before = 0, {}
            closed = bool(entry.get("closed"))
            released = bool(begin and before.get("closed"))
            if begin == entry["end"] and (not closed or released):
                return None
            return _Part(name, begin, entry["end"], closed, released)

        with ThreadPoolExecutor(_READERS) as readers:
            parts = readers.map(part, sorted(end))
            return _plan(self.settings, [found for found in parts if found])

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.settings.chunk_bytes)


class LogLines(DataSource):
    """``format("loglines")``; options ``path``, ``fileNameRegex``, ``splitBytes``,
    ``chunkBytes``, ``maxRanges`` and, for streams, ``maxBytesPerTrigger``,
    ``lastLineAfterSeconds``, ``checkpointLocation`` (the query's, so that the limit holds from
    the first batch after a restart) and ``sourceIndex`` (which of the query's sources this is)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _LinesReader(_Settings.of(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LinesStream(_Settings.of(self.options))


def scan_logs(spark: SparkSession, path: str, names: str = ".*", **options: object) -> DataFrame:
    """All lines of the files directly in ``path``; no rows if it is missing."""
    spark.dataSource.register(LogLines)
    reader = spark.read.format(FORMAT).option("fileNameRegex", names)
    return reader.options(**options).load(path)


def tail_logs(spark: SparkSession, path: str, names: str = PRODUCER_FILES, **options: object) -> DataFrame:
    """Stream of the lines in ``path``: what is there at the start, then all that
    is appended, and new files as they come."""
    spark.dataSource.register(LogLines)
    reader = spark.readStream.format(FORMAT).option("fileNameRegex", names)
    return reader.options(**options).load(path)
