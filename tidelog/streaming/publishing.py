"""Publishing tailed lines: dates over midnight, lines without a time set aside."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.clock import with_leading_time
from tidelog.functions.envelope import encode, parse_line
from tidelog.operators.positions import assign_dates
from tidelog.operators.select import Window, file_time_window, untimed
from tidelog.sinks.tables import write_batch

CLOCKS = "file_name string, day date, tod string"


def publish(lines: DataFrame, windows: Sequence[Window], single: bool = True) -> DataFrame:
    """Envelopes of the lines inside their file's time window. Position and
    ``log_date`` travel as extra fields."""
    chosen = file_time_window(lines, windows, single, ordered=False)
    records = parse_line(chosen, keep=("pos", "log_date"))
    return records.select(encode(extras=("pos", "log_date")).alias("value"))


def _named_day(file_name: Column) -> Column:
    """The date in a rolled file's name."""
    return F.try_to_date(F.regexp_extract(file_name, r"(?:^|[^0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[^0-9]|$)", 1))


def dated(lines: DataFrame, clocks: DataFrame, day: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The lines with ``log_date``, and the newest clock of every file.

    A file begins on the day of its name, else on ``day``; each step of its clock back
    over more than half a day is a midnight. ``clocks`` holds where each file stood: it
    goes before the file's lines, so midnights between two batches count as well.
    """
    stood = clocks.select("file_name", F.col("day").alias("_day"))
    timed = with_leading_time(lines.select("file_name", "pos", "value")).join(stood, "file_name", "left")
    first = F.coalesce("_day", _named_day(F.col("file_name")), F.lit(day).cast("date"))
    rows = timed.withColumn("first_day", first).drop("_day")
    before = clocks.select("file_name", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("value"), "tod", F.col("day").alias("first_day"))
    found = assign_dates(rows.unionByName(before)).withColumn("log_date", F.col("event_ts").cast("date"))
    newest = found.where("tod IS NOT NULL AND log_date IS NOT NULL").groupBy("file_name")
    newest = newest.agg(F.max_by(F.struct("log_date", "tod"), "pos").alias("_last"))
    clocked = newest.select("file_name", F.col("_last.log_date").alias("day"), F.col("_last.tod").alias("tod"))
    lines_only = found.where("pos >= 0").withColumn("log_date", F.col("log_date").cast("string"))
    return lines_only.select("file_name", "pos", "value", "log_date"), clocked


def publish_action(
    send: Callable[[DataFrame, int], None],
    windows: Sequence[Window],
    state: str,
    rejects: str,
    single: bool = True,
    day: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch action: date the lines, send those in their time window, set those
    without a time aside, and keep every file's clock for the next batch. A batch that
    is run again starts from the same clocks and replaces its own folders."""

    def act(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch_id:
                clocks = spark.read.schema(CLOCKS).parquet(f"{state}/batch_id={batch_id - 1}")
            else:
                clocks = spark.createDataFrame([], CLOCKS)
            rows, newest = dated(lines, clocks, day)
            send(publish(rows, windows, single), batch_id)
            aside = untimed(lines)
            if not aside.isEmpty():
                write_batch(aside.select("file_name", "pos", "value"), rejects, batch_id)
            write_batch(newest, state, batch_id)
        finally:
            lines.unpersist()

    return act
