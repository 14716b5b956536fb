"""Sparse time index of log files, and reads that seek by time of day.

A log is nearly sorted by time, so a window of a day lies in few places of a file. The index has
one row per granule, some whole lines that lie side by side: its bytes, its least and greatest
leading time, and how many of its lines have none. A granule ends at midnight as well, where
the clock goes back. One pass over the files makes it, without a shuffle of lines, and a later
pass adds only what has come since.

Lines read through the index have their leading time in ``tod``. The times sought are options of
the source, which plans only granules that may hold such lines; what the index does not cover
(later lines, an open last line, new and replaced files) is read whole. So an old or empty
index costs time and never rows.

The times are no pushed filters: Spark 4.1 keeps the ranges planned for one query's filters
with the loaded table, and a second query over the same DataFrame would read those of the first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidelog.functions.clock import TIME_OF_DAY, normal_time
from tidelog.functions.text import INSTANCE_PATTERN
from tidelog.operators.select import Window, file_time_window, normal_windows
from tidelog.sources.loglines import _READERS, ByteRange, _batch, _blocks, _digest, _listing, _Part, _plan, _Settings

INDEX = "loglines_index"
TIMED = "loglines_timed"

#: Granules of an index, which the driver reads to plan: they grow with the files beyond that.
MOST_GRANULES = 1_000_000
GRANULE_BYTES = 1 << 20
#: Midnights that cut one block; a block whose clock goes back more often stays whole.
MOST_CUTS = 8

_MARK = 256
_HALF_DAY = 12 * 3600
_INDEX_SCHEMA = (
    "file_name string, generation int, start bigint, stop bigint, least string, greatest string, "
    "untimed bigint, head string, tail string, size bigint, modified bigint"
)
_TIMED_SCHEMA = "file_name string, pos bigint, value string, tod string"


def leading_times(lines: pa.Array, separator: str = " ") -> pa.Array:
    """:func:`tidelog.functions.clock.leading_time` of an Arrow array of lines."""
    pattern = f"^(?P<clock>{TIME_OF_DAY})(?:\\Q{separator}\\E|\\z)"
    found = pc.struct_field(pc.extract_regex(lines, pattern), "clock")
    usual = pc.fill_null(pc.equal(pc.binary_length(found), len("HH:mm:ss.SSS")), True)
    if pc.all(usual).as_py() is not False:
        return found
    coded = found.dictionary_encode()
    known = pa.array([normal_time(clock) for clock in coded.dictionary.to_pylist()], pa.string())
    return known.take(coded.indices)


def _midnights(times: pa.Array) -> np.ndarray:
    """Lines at which the clock has gone back by over half a day."""
    timed = np.flatnonzero(times.is_valid().to_numpy(zero_copy_only=False))
    clock = times.take(pa.array(timed))

    def number(at: int) -> np.ndarray:
        return pc.cast(pc.utf8_slice_codeunits(clock, at, at + 2), pa.int32()).to_numpy()

    seconds = number(0) * 3600 + number(3) * 60 + number(6)
    cuts = timed[1:][np.diff(seconds) < -_HALF_DAY]
    return cuts if len(cuts) <= MOST_CUTS else cuts[:0]


@dataclass
class _ToIndex(InputPartition):
    part: ByteRange
    generation: int
    size: int
    modified: int
    granule: int


def _granules(task: _ToIndex, separator: str) -> Iterator[tuple]:
    for first, block in _blocks(task.part, task.granule):
        batch = _batch(task.part.file_name, first, block)
        times = leading_times(batch.column("value"), separator)
        cuts = [0, *_midnights(times).tolist(), len(times)]
        starts = batch.column("pos").to_numpy()
        places = [*(int(starts[cut]) for cut in cuts[:-1]), first + len(block)]
        for i, (start, stop) in enumerate(zip(places[:-1], places[1:], strict=True)):
            clocks = times.slice(cuts[i], cuts[i + 1] - cuts[i])
            ends = pc.min_max(clocks).as_py()
            held = block[start - first : stop - first]
            yield (
                task.part.file_name,
                task.generation,
                start,
                stop,
                ends["min"],
                ends["max"],
                clocks.null_count,
                _digest(held[:_MARK]) if start == 0 else None,
                _digest(held[-_MARK:]),
                task.size,
                task.modified,
            )


@dataclass(frozen=True)
class _Covered:
    """Granules of a file, side by side from its start."""

    granules: pd.DataFrame
    generation: int
    valid: bool

    @property
    def end(self) -> int:
        return int(self.granules["stop"].iloc[-1]) if self.valid else 0


def _unchanged(folder: str, info: pafs.FileInfo, rows: pd.DataFrame) -> bool:
    """Whether a file is what was indexed, or that and more.

    A file that has not grown must not have been written since. One that has must still begin
    and, up to the indexed end, end with the same bytes.
    """
    starts, stops = rows["start"].to_numpy(), rows["stop"].to_numpy()
    if starts[0] != 0 or (starts[1:] != stops[:-1]).any() or stops[-1] > info.size:
        return False
    last = rows.iloc[-1]
    if info.size <= last["size"] and info.mtime_ns != last["modified"]:
        return False
    system, inner = pafs.FileSystem.from_uri(f"{folder.rstrip('/')}/{info.base_name}")
    with system.open_input_file(inner) as source:
        head = source.read_at(int(min(_MARK, stops[0])), 0)
        size = int(min(_MARK, stops[-1] - starts[-1]))
        tail = source.read_at(size, int(stops[-1]) - size)
    return _digest(head) == rows["head"].iloc[0] and _digest(tail) == last["tail"]


def _coverage(settings: _Settings, index: str, infos: list[pafs.FileInfo]) -> dict[str, _Covered]:
    """What the index knows of the files; at most about MOST_GRANULES rows."""
    system, inner = pafs.FileSystem.from_uri(index)
    if system.get_file_info(inner).type != pafs.FileType.Directory:
        return {}
    stored = pads.dataset(inner, filesystem=system, format="parquet")
    if not stored.files:
        return {}
    rows = stored.to_table().to_pandas()
    rows = rows[rows["generation"] == rows.groupby("file_name")["generation"].transform("max")]
    by_name = dict(iter(rows.sort_values(["file_name", "start", "stop"]).groupby("file_name", sort=False)))

    def covered(info: pafs.FileInfo) -> tuple[str, _Covered]:
        found = by_name[info.base_name]
        return info.base_name, _Covered(found, int(found["generation"].iloc[0]), _unchanged(settings.path, info, found))

    with ThreadPoolExecutor(_READERS) as readers:
        return dict(readers.map(covered, [info for info in infos if info.base_name in by_name]))


class _IndexReader(DataSourceReader):
    """Index rows of what the index does not cover yet. A file that was replaced gets rows of
    a new generation, which hold instead of the older ones."""

    def __init__(self, settings: _Settings, index: str, separator: str):
        self.settings, self.index, self.separator = settings, index, separator

    def partitions(self) -> list[_ToIndex]:
        infos = {i.base_name: i for i in _listing(self.settings.path, self.settings.names) if i.size}
        covered = _coverage(self.settings, self.index, list(infos.values()))
        known = {name: covered[name].end if name in covered else 0 for name in infos}
        parts = [_Part(name, known[name], info.size) for name, info in infos.items() if known[name] < info.size]
        granule = max(self.settings.chunk_bytes, -(-sum(i.size for i in infos.values()) // MOST_GRANULES))
        generations = {name: found.generation + (not found.valid) for name, found in covered.items()}
        return [
            _ToIndex(
                part,
                generations.get(part.file_name, 0),
                infos[part.file_name].size,
                infos[part.file_name].mtime_ns or 0,
                granule,
            )
            for part in _plan(replace(self.settings, split_bytes=max(granule, self.settings.split_bytes)), parts)
        ]

    def read(self, partition: _ToIndex) -> Iterator[tuple]:
        return iter(()) if partition is None else _granules(partition, self.separator)


@dataclass
class _Sought:
    part: ByteRange
    least: str | None
    greatest: str | None


@dataclass
class _Task(InputPartition):
    sought: list[_Sought]

    @property
    def size(self) -> int:
        return sum(one.part.stop - one.part.start for one in self.sought)


@dataclass(frozen=True)
class _Wanted:
    """Times from ``least`` to ``greatest``, or lines ``untimed``; by the file's number, if there are
    ``windows`` (``single``: the first for all files)."""

    least: str | None = None
    greatest: str | None = None
    untimed: bool = False
    windows: list[Window] | None = None
    single: bool = False


class _TimedReader(DataSourceReader):
    """The wanted lines with their leading time, of the granules that may hold some."""

    def __init__(self, settings: _Settings, index: str, separator: str, wanted: _Wanted):
        self.settings, self.index, self.separator, self.wanted = settings, index, separator, wanted

    def _bounds(self, name: str) -> Window:
        """Bounds for a file; one without a window of its own is left to the window's check."""
        wanted = self.wanted
        if wanted.windows is None:
            return wanted.least, wanted.greatest
        number = 1 if wanted.single else int((re.search(INSTANCE_PATTERN, name) or [0, 0])[1])
        return tuple(wanted.windows[number - 1]) if 1 <= number <= len(wanted.windows) else (None, None)

    def _meeting(self, granules: pd.DataFrame, bounds: Window) -> pd.DataFrame:
        keep = np.ones(len(granules), bool)
        if self.wanted.untimed:
            keep &= (granules["untimed"] > 0).to_numpy()
        if bounds[0] is not None:
            keep &= (granules["greatest"].fillna("") >= bounds[0]).to_numpy()
        if bounds[1] is not None:
            keep &= granules["least"].notna().to_numpy() & (granules["least"].fillna("") <= bounds[1]).to_numpy()
        return granules[keep]

    def partitions(self) -> list[_Task]:
        infos = [i for i in _listing(self.settings.path, self.settings.names) if i.size]
        covered = _coverage(self.settings, self.index, infos)
        parts, bounds = [], {}
        for info in infos:
            name, found = info.base_name, covered.get(info.base_name)
            bounds[name] = self._bounds(name)
            end = found.end if found else 0
            if end:
                meeting = self._meeting(found.granules, bounds[name])
                starts, stops = meeting["start"].to_numpy(), meeting["stop"].to_numpy()
                first = np.append(True, starts[1:] != stops[:-1])[: len(starts)]  # runs side by side
                last = np.append(first[1:], True)[: len(starts)]
                parts += [_Part(name, int(a), int(b)) for a, b in zip(starts[first], stops[last], strict=True)]
            if end < info.size:
                parts.append(_Part(name, end, info.size, to_end=True))
        tasks: list[_Task] = []
        room = 0
        for part in _plan(self.settings, parts):
            size = part.stop - part.start
            if not tasks or size > room:
                tasks.append(_Task([]))
                room = self.settings.split_bytes
            tasks[-1].sought.append(_Sought(part, *bounds[part.file_name]))
            room -= size
        return tasks

    def read(self, partition: _Task) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        for one in partition.sought:
            for first, block in _blocks(one.part, self.settings.chunk_bytes):
                batch = _batch(one.part.file_name, first, block)
                times = leading_times(batch.column("value"), self.separator)
                found = batch.append_column("tod", times)
                if self.wanted.untimed:
                    found = found.filter(times.is_null())
                if one.least is not None:
                    found = found.filter(pc.greater_equal(found.column("tod"), one.least))
                if one.greatest is not None:
                    found = found.filter(pc.less_equal(found.column("tod"), one.greatest))
                if found.num_rows:
                    yield found


class LogIndex(DataSource):
    """``format("loglines_index")``: rows to add to the index in option ``index``. Further options
    as in :class:`tidelog.sources.loglines.LogLines`; ``chunkBytes`` is the size of a granule."""

    @classmethod
    def name(cls) -> str:
        return INDEX

    def schema(self) -> str:
        return _INDEX_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _IndexReader(_Settings.of(self.options), self.options["index"], self.options.get("separator", " "))


class TimedLines(DataSource):
    """``format("loglines_timed")``: lines with their leading time, read through the index in option
    ``index``. ``wanted`` is a JSON object of the fields of :class:`_Wanted`; all lines without it."""

    @classmethod
    def name(cls) -> str:
        return TIMED

    def schema(self) -> str:
        return _TIMED_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        wanted = _Wanted(**json.loads(self.options.get("wanted", "{}")))
        return _TimedReader(_Settings.of(self.options), self.options["index"], self.options.get("separator", " "), wanted)


def index_logs(
    spark: SparkSession, path: str, index: str, names: str = ".*", granule_bytes: int = GRANULE_BYTES, **options: object
) -> None:
    """Add to the index in folder ``index`` what it does not cover of the files in ``path``.

    Null or malformed times count as untimed; empty files and an open last line have no granule.
    A failed run adds nothing. One run at a time: granules added twice leave a file uncovered
    until the index is made anew.
    """
    spark.dataSource.register(LogIndex)
    reader = spark.read.format(INDEX).option("fileNameRegex", names).option("index", index)
    rows = reader.option("chunkBytes", granule_bytes).options(**options).load(path)
    rows.repartition("file_name", "start").write.mode("append").parquet(index)


def timed_logs(
    spark: SparkSession, path: str, index: str, names: str = ".*", wanted: dict[str, object] | None = None, **options: object
) -> DataFrame:
    """Lines as ``(file_name, pos, value, tod)``: all, or those that ``wanted`` names (``least`` and
    ``greatest`` in the form of :func:`normal_time`, both included; ``untimed``)."""
    spark.dataSource.register(TimedLines)
    reader = spark.read.format(TIMED).option("fileNameRegex", names).option("index", index)
    return reader.option("wanted", json.dumps(wanted or {})).options(**options).load(path)


def seek_time_window(
    spark: SparkSession, path: str, index: str, start: str, end: str, names: str = ".*", ordered: bool = True, **options: object
) -> DataFrame:
    """:func:`tidelog.operators.select.time_window` over log files, by seeking."""
    wanted = {"least": normal_time(start), "greatest": normal_time(end)}
    chosen = timed_logs(spark, path, index, names, wanted, **options)
    return chosen.orderBy("tod", "file_name", "pos") if ordered else chosen


def seek_untimed(spark: SparkSession, path: str, index: str, names: str = ".*", **options: object) -> DataFrame:
    """:func:`tidelog.operators.select.untimed` over log files: only granules with such lines are read."""
    return timed_logs(spark, path, index, names, {"untimed": True}, **options).drop("tod")


def seek_file_windows(
    spark: SparkSession,
    path: str,
    index: str,
    windows: Sequence[Window],
    single: bool = False,
    names: str = ".*",
    ordered: bool = True,
    **options: object,
) -> DataFrame:
    """:func:`tidelog.operators.select.file_time_window` over log files, by seeking.

    A file without a window is read whole, so that its lines fail the job there as well.
    """
    wanted = {"windows": normal_windows(windows), "single": single}
    lines = timed_logs(spark, path, index, names, wanted, **options).drop("tod")
    return file_time_window(lines, windows, single, separator=str(options.get("separator", " ")), ordered=ordered)
