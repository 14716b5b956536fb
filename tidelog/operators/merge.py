"""Keyed rows: latest version per key, and rows not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str = "log_id", version: Sequence[str] = ("version",)) -> DataFrame:
    """The row of greatest ``version`` for each key.

    An aggregation rather than a ranking: tasks combine their own copies first,
    so a key repeated very often is not gathered anywhere. Equal versions are
    told apart by the row's content, which keeps the result repeatable.
    """
    rest = [c for c in rows.columns if c != key and c not in version]
    picked = rows.groupBy(key).agg(F.max(F.struct(*version, *rest)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}") for c in rows.columns])


def reach(batch: DataFrame, part: str = "event_date", ts: str = "event_ts") -> Row:
    """The dates (``parts``, one entry per calendar day) and the time range of a batch."""
    return batch.agg(F.collect_set(part).alias("parts"), F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()


def new_rows(
    batch: DataFrame, stored: DataFrame, span: Row, key: str = "log_id", part: str = "event_date", ts: str = "event_ts"
) -> DataFrame:
    """Distinct rows of ``batch`` whose key is not stored.

    A key holds the row's date and time, so a stored copy has the same ones: within
    ``span``, the batch's ``reach``, only row groups that meet its time range are
    read, and only their keys.
    """
    near = stored.where(F.col(part).isin(span["parts"]))
    if span["lo"] is None:
        near = near.where(F.col(ts).isNull())
    else:
        lo, hi = (F.lit(str(span[side])).cast(batch.schema[ts].dataType) for side in ("lo", "hi"))
        near = near.where(F.col(ts).isNull() | F.col(ts).between(lo, hi))
    return batch.dropDuplicates([key]).join(near.select(key), key, "left_anti")
