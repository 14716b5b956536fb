"""Windowed counts and event-anchored windows on a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.clock import from_micros, micros
from tidelog.operators.anchored import CARRIED, resumed_windows
from tidelog.operators.windows import tumbling_count
from tidelog.sinks.tables import write_batch


def stream_tumbling_count(
    rows: DataFrame, seconds: int, delay: str, level: str | None = None, ts: str = "event_ts"
) -> DataFrame:
    """Tumbling counts that are final once the watermark has passed a window. Rows
    later than ``delay`` are dropped and counted in the query's progress (:func:`counted_action`
    keeps them).

    Watermarks exist only on zoned timestamps, so a zone-free time is read as UTC
    inside and given back zone-free: the session's zone has no part in it.
    """
    timed = rows.withColumn("_event", F.timestamp_micros(micros(rows, ts)))
    counted = tumbling_count(timed.withWatermark("_event", delay), seconds, level, "_event")
    start = counted.withColumn("_start", F.unix_micros("window_start"))
    return start.select(from_micros(rows, ts, "_start").alias("window_start"), "n_logs")


def changed_windows(path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch action for counts in update mode: each batch's changed windows go to
    a folder of their own, so the open window is there as well as the closed ones."""

    def act(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return act


def newest_windows(changes: DataFrame, key: str = "window_start", batch: str = "batch_id") -> DataFrame:
    """The last state of every window: one narrow version per window is aggregated and
    joined back."""
    newest = changes.groupBy(key).agg(F.max(batch).alias(batch))
    return changes.join(newest, [key, batch]).drop(batch)


#: Greatest event time of all batches so far, in microseconds; null before the first time.
_REACHED = "latest bigint"
_MICROS = 1_000_000


@dataclass(frozen=True)
class CountedTarget:
    """Folder of streamed counts: ``counts``, ``late`` rows and ``state``, by batch."""

    path: str

    @property
    def counts(self) -> str:
        return f"{self.path}/counts"

    @property
    def late(self) -> str:
        return f"{self.path}/late"

    @property
    def state(self) -> str:
        return f"{self.path}/state"


def counted_action(
    target: CountedTarget,
    seconds: int,
    delay_seconds: int,
    level: str | None = None,
    ts: str = "event_ts",
    level_column: str = "log_type",
) -> Callable[[DataFrame, int], None]:
    """Micro-batch action for tumbling counts that keeps the rows it does not count.

    The watermark of a batch is the greatest time of all earlier batches less the delay. A row is
    late if its window ended by then, as in :func:`stream_tumbling_count`. Late rows, and rows
    without a time, go to a folder of their own with that ``watermark`` (null before the first
    time), so counts and late rows together are the input. A batch adds its own counts of each
    window; what is carried from one to the next is one time. A batch that is run again starts
    from the same state and replaces its own folders.
    """
    width = int(seconds) * _MICROS

    def act(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = None
        if batch_id:
            latest = spark.read.schema(_REACHED).parquet(f"{target.state}/batch_id={batch_id - 1}").first()["latest"]
        mark = None if latest is None else latest - int(delay_seconds) * _MICROS
        kept = batch if level is None else batch.where(F.col(level_column) == level)
        rows = kept.withColumn("_moment", micros(kept, ts)).persist(StorageLevel.MEMORY_AND_DISK)
        start = F.col("_moment") - F.pmod(F.col("_moment"), F.lit(width))
        late = F.col("_moment").isNull()
        if mark is not None:
            late = late | (start + width <= mark)
        try:
            counted = rows.where(~late).groupBy(start.alias("_start")).agg(F.count("*").alias("n_logs"))
            write_batch(counted.select(from_micros(batch, ts, "_start").alias("window_start"), "n_logs"), target.counts, batch_id)
            marked = rows.where(late).withColumn("_mark", F.lit(mark).cast("bigint"))
            write_batch(marked.select(*batch.columns, from_micros(batch, ts, "_mark").alias("watermark")), target.late, batch_id)
            reached = rows.agg(F.greatest(F.max("_moment"), F.lit(latest).cast("bigint")).alias("latest"))
            write_batch(reached, target.state, batch_id)
        finally:
            rows.unpersist()

    return act


def counted_windows(spark: SparkSession, target: CountedTarget) -> DataFrame:
    """``(window_start, n_logs)`` of all batches."""
    return spark.read.parquet(target.counts).groupBy("window_start").agg(F.sum("n_logs").alias("n_logs"))


def late_rows(spark: SparkSession, target: CountedTarget) -> DataFrame:
    """The rows that came too late, or without a time, with ``watermark`` and ``batch_id``."""
    return spark.read.parquet(target.late)


@dataclass(frozen=True)
class AnchoredTarget:
    """Folder of a streamed anchored-window table: ``rows`` and ``state`` per batch."""

    path: str

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def state(self) -> str:
        return f"{self.path}/state"


def anchored_action(
    target: AnchoredTarget, minutes: float = 1, keys: Sequence[str] = ("file_name",), ts: str = "event_ts"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch action that labels rows with their event-anchored windows.

    The open window of every key (one row each) is written with the batch and read
    by the next one. Inside a batch the chains are computed by the distributed
    operator, so neither a large first batch nor a key holding most of it is ever
    one group, as it would be in a keyed state function. A batch that is run again
    starts from the same state and replaces its own folders.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id:
            carried = spark.read.schema(CARRIED).parquet(f"{target.state}/batch_id={batch_id - 1}")
        else:
            carried = spark.createDataFrame([], CARRIED)
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            labelled, newest = resumed_windows(rows, carried, ts, minutes, keys)
            write_batch(labelled, target.rows, batch_id)
            write_batch(newest, target.state, batch_id)
        finally:
            rows.unpersist()

    return act
