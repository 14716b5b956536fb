"""Idempotent writers: running any of them again for the same batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidelog.operators.merge import new_rows, reach
from tidelog.session import written_table
from tidelog.sources.tables import log_table, with_event_date


def _balanced(rows: DataFrame) -> DataFrame:
    """Few files per date without gathering a large date in one task, and time
    order inside the files so that readers skip row groups by their time range."""
    return rows.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event_ts")


def upsert_rows(rows: DataFrame, path: str) -> None:
    """Insert rows by key. The key is made from a row's content, place and date, so a
    key already stored holds the same row and is skipped. The rows are evaluated once
    and kept while they are compared; of the table only their dates are listed."""
    dated = with_event_date(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        span = reach(dated)
        stored = log_table(rows.sparkSession, path, span["parts"])
        _balanced(new_rows(dated, stored, span)).write.mode("append").partitionBy("event_date").parquet(path)
    finally:
        dated.unpersist()


def compact_date(spark: SparkSession, path: str, date: str) -> None:
    """Rewrite the rows of one date in few files, in time order.

    Small batches add a file each; this is for a date that no batch writes to any
    more. The rows are first written beside the table, so a failure loses nothing.
    """
    columns = [name for name in log_table(spark, path).columns if name != "event_date"]
    rows = written_table(log_table(spark, path, [date]).select(*columns), "compacting")
    ordered = rows.hint("rebalance").sortWithinPartitions("event_ts")
    ordered.write.mode("overwrite").parquet(f"{path}/event_date={date}")


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch's rows to its own folder, replacing an earlier try."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_consolidated(lines: DataFrame, path: str) -> None:
    """Replace ``path`` by all lines in file and line order.

    ``lines`` come from ``scan_logs``, whose partitions are byte ranges in that order
    already, so they are written as they are. The result stays many part files, whose
    names follow the order.
    """
    lines.select("value").write.mode("overwrite").text(path)


_STORES: dict[str, Callable[[DataFrame, str], None]] = {"table": upsert_rows}


def store(kind: str) -> Callable[[DataFrame, str], None]:
    """Writer of stored rows by name; an unknown name fails before any query starts."""
    if kind not in _STORES:
        raise ValueError(f"unsupported store {kind!r}; known: {', '.join(sorted(_STORES))}")
    return _STORES[kind]
