"""The pipeline's jobs: monitor log files, consume messages, serve the dashboard."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.anchored import anchored_windows
from tidelog.operators.select import Window, filter_levels, search, table_view
from tidelog.operators.summary import level_counts
from tidelog.operators.windows import level_series
from tidelog.sources.loglines import PRODUCER_FILES, scan_logs, tail_logs
from tidelog.sources.topic import message_sender
from tidelog.sinks.tables import write_consolidated
from tidelog.streaming.batches import Targets, batch_action
from tidelog.streaming.publishing import publish_action

BATCH_INTERVAL = "2 seconds"


def monitor(
    spark: SparkSession,
    folder: str,
    windows: Sequence[Window],
    checkpoint: str,
    transport: str,
    single: bool = True,
    day: str | None = None,
    names: str = PRODUCER_FILES,
    source: dict | None = None,
    untimed: str | None = None,
    **target: str,
) -> DataStreamWriter:
    """Tail all log files of a folder and publish their lines. Offsets are committed
    after a batch is published, so a failure repeats lines and never loses them;
    the consumer's keys remove the repeats. Lines without a leading time go to the
    folder ``untimed`` (by default beside the checkpoint), and every file's clock is
    kept there too, so that its date goes on over midnight and restarts."""
    base = checkpoint.rstrip("/")
    send = message_sender(transport, **target)
    action = publish_action(send, windows, f"{base}-clocks", untimed or f"{base}-untimed", single, day)
    lines = tail_logs(spark, folder, names, **({"checkpointLocation": checkpoint} | (source or {})))
    return lines.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)


def consume(messages: DataFrame, targets: Targets, checkpoint: str, interval: str = BATCH_INTERVAL) -> DataStreamWriter:
    """Decode messages and act on each micro-batch."""
    return (
        messages.writeStream.foreachBatch(batch_action(targets))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )


def consolidate_logs(spark: SparkSession, folder: str, path: str, names: str = ".*") -> None:
    """Replace ``path`` by all lines of a folder's files."""
    write_consolidated(scan_logs(spark, folder, names), path)


def dashboard(
    rows: DataFrame, levels: Iterable[str] = (), needle: str = "", minutes: float = 1
) -> dict[str, DataFrame]:
    """The dashboard's three results: pie of levels, line series per level over
    event-anchored windows of all rows, and the table of matching rows."""
    wanted = list(levels)
    windows = anchored_windows(rows, minutes=minutes)
    return {
        "pie": filter_levels(level_counts(rows), wanted, "id"),
        "lines": filter_levels(level_series(windows), wanted, "level"),
        "table": table_view(search(rows, needle, wanted), with_file=True),
    }
