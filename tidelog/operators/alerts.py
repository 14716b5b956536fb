"""Error alerts: one per slice that holds at least three errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALERT_SIZE = 3


def escape_html(text: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def alert_body(messages: Sequence[Column]) -> Column:
    """Alert text: each message as an escaped paragraph."""
    return F.concat(*[part for m in messages for part in (F.lit("<p>"), escape_html(m), F.lit("</p>"))])


def batch_alerts(
    rows: DataFrame,
    by: Sequence[Column | str] = (),
    order: Sequence[str] = ("event_ts", "file_name", "src_pos"),
    size: int = ALERT_SIZE,
    level: str = "log_type",
    message: str = "log_message",
) -> DataFrame:
    """Alerts per slice: number of errors and the first messages in ``order``.

    Counting is a partial aggregation, and each task keeps only its first
    ``size`` rows of a slice before the shuffle, so a slice holding most of the
    errors moves as little data as any other.
    """
    sliced = rows.where(F.col(level) == "ERROR").select(
        *[F.col(c).alias(c) if isinstance(c, str) else c for c in by], *order, F.col(message).alias("_message")
    )
    keys = sliced.columns[: len(by)]
    tally = sliced.groupBy(*keys).agg(F.count("*").alias("n_errors")).where(F.col("n_errors") >= size)
    if keys:
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        firsts = sliced.withColumn("_n", nth).where(F.col("_n") <= size)
    else:
        top = sliced.orderBy(*order).limit(size)
        firsts = top.withColumn("_n", F.row_number().over(Window.orderBy(*order)))
    slots = [F.max(F.when(F.col("_n") == i, F.col("_message"))).alias(f"message{i}") for i in range(1, size + 1)]
    spread = firsts.groupBy(*keys).agg(*slots)
    if keys:
        found = tally.join(spread, keys)
    else:  # one row each: side by side through one more aggregate
        both = tally.unionByName(spread, allowMissingColumns=True)
        found = both.agg(*[F.max(c).alias(c) for c in both.columns]).where(F.col("n_errors") >= size)
    messages = [F.coalesce(F.col(f"message{i}"), F.lit("")) for i in range(1, size + 1)]
    return found.withColumn("body", alert_body(messages))
