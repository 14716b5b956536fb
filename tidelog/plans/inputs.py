"""Log tables derived from the given tables, for the registered queries.

Every row of ``events`` becomes one log line of one of twelve files; its key is
the line's position. The event time stays beside the line for operators that work
on stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.envelope import log_key

# Level written for each event type. SEVERE is no producer level, and nothing
# maps to WARNING, so that zero counts show.
EVENT_LEVELS = {"error": "ERROR", "signup": "WARN", "click": "DEBUG", "view": "INFO", "purchase": "SEVERE"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _level(width: int = 0) -> Column:
    """Level of an event, filled with blanks up to a width as in a log line."""
    out = F.lit(None)
    for kind, level in EVENT_LEVELS.items():
        out = F.when(F.col("event_type") == kind, F.lit(level.ljust(width))).otherwise(out)
    return out.cast("string")


def events_as_logs(events: DataFrame) -> DataFrame:
    """Events with the parts of a log line: file, position, level, clock."""
    return events.select(
        F.concat(F.lit("output"), (F.col("user_id") % 12 + 1).cast("string"), F.lit(".log")).alias("file_name"),
        F.col("event_id").alias("pos"),
        F.date_format("ts", "HH:mm:ss.SSS").alias("clock"),
        _level().alias("lvl"),
        "ts",
        "user_id",
        "event_type",
        "props",
        F.col("value").alias("score"),
    )


def _line(*message: Column) -> Column:
    thread = F.concat(F.lit(" [thread-"), F.col("user_id").cast("string"), F.lit("] "))
    return F.concat("clock", thread, _level(5), F.lit(" app.Logger - "), *message)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines ``(file_name, pos, value)``."""
    logs = events_as_logs(table(spark, sf_dir, "events"))
    return logs.select("file_name", "pos", _line(F.col("props")).alias("value"))


def wordy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines whose message itself holds the separator, tabs and end blanks."""
    logs = events_as_logs(table(spark, sf_dir, "events"))
    message = [F.lit("\t"), F.col("event_type"), F.lit(" - "), F.col("props"), F.lit(" \t - ")]
    return logs.select("file_name", "pos", _line(*message).alias("value"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as log messages, one per row: ``(file_name, pos, value)``."""
    docs = table(spark, sf_dir, "documents")
    head = F.concat(F.lit("00:00:00.000 ["), F.col("source"), F.lit("] INFO  app.Documents - "))
    return docs.select(
        F.concat("lang", F.lit(".log")).alias("file_name"),
        F.col("doc_id").alias("pos"),
        F.concat(head, F.col("text")).alias("value"),
    )


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored log table, with all dashboard levels in use."""
    logs = events_as_logs(table(spark, sf_dir, "events"))
    rows = logs.select(
        "file_name",
        F.col("clock").alias("timestamp"),
        F.col("lvl").alias("log_type"),
        F.col("props").alias("log_message"),
        F.col("ts").alias("event_ts"),
        F.col("pos").alias("src_pos"),
    )
    return rows.select(log_key(F.col("src_pos")).alias("log_id"), *rows.columns)
