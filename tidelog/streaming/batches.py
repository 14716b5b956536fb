"""Actions on each micro-batch of decoded messages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.envelope import FIELDS, decode, to_log_data
from tidelog.operators.alerts import ALERT_SIZE, batch_alerts
from tidelog.sinks.tables import store, write_batch

# Copies of one record that one task numbers at a time.
COPIES = 1 << 16


@dataclass(frozen=True)
class Targets:
    """Where a consumer writes; ``day`` dates messages that carry none."""

    stored: str
    alerts: str
    rejects: str
    kind: str = "table"
    day: str | None = None


def batch_action(targets: Targets) -> Callable[[DataFrame, int], None]:
    """Save the batch's valid rows, set its rejects aside, and raise an alert if it
    holds enough errors. The batch is parsed once and kept for all three; one count of
    its parts tells which of them it has, and what is empty leaves no folder."""
    save = store(targets.kind)

    def act(batch: DataFrame, batch_id: int) -> None:
        arrival = [c for c in ("msg_partition", "msg_offset", "msg_file") if c in batch.columns]
        decoded = decode(batch.select("value", *arrival)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            error = F.col("valid") & (F.col("level") == "ERROR")
            n_valid, n_rejects, n_errors = decoded.agg(
                F.count_if("valid"), F.count_if(~F.col("valid")), F.count_if(error)
            ).first()
            if n_valid:
                placed = decoded.where("valid")
                if "msg_offset" not in arrival:
                    placed = numbered_copies(placed, batch_id)
                rows = to_log_data(placed, targets.day, keep=arrival)
                save(rows.drop(*arrival), targets.stored)
            if n_rejects:
                write_batch(decoded.where(~F.col("valid")).select("value"), targets.rejects, batch_id)
            if n_errors >= ALERT_SIZE:
                order = arrival if "msg_offset" in arrival else ("file_name", "src_pos", "timestamp")
                write_batch(batch_alerts(rows, order=(*order, "log_id")), targets.alerts, batch_id)
        finally:
            decoded.unpersist()

    return act


def numbered_copies(rows: DataFrame, batch_id: int, copies: int = COPIES) -> DataFrame:
    """Records with ``msg_copy``: which of the equal records of its landed file (else of its
    batch) a record without position is, from 1; null for one with a position.

    Equal records are interchangeable, so they are counted, which tasks do for their own rows
    before the shuffle, and unfolded again. A record with more than ``copies`` copies is
    unfolded in parts by several tasks: however often a message is repeated, its copies are
    never gathered, and none is lost to a common key.
    """
    known = rows if "msg_file" in rows.columns else rows.withColumn("msg_file", F.lit(f"batch {batch_id}"))
    record = ["msg_file", *FIELDS, "log_date"]
    counted = known.where("pos IS NULL").groupBy(*record).agg(F.count("*").alias("_copies"))

    def unfolded(part: DataFrame, first: str, last: str) -> DataFrame:
        return part.select(*record, F.explode(F.expr(f"sequence({first}, {last})")).alias("msg_copy"))

    few = unfolded(counted.where(F.col("_copies") <= copies), "1L", "_copies")
    parts = F.explode(F.expr(f"sequence(0L, (_copies - 1) div {copies})"))
    many = counted.where(F.col("_copies") > copies).select(*record, "_copies", parts.alias("_part"))
    last = f"least(_copies, (_part + 1) * {copies})"
    many = unfolded(many.repartition(*record, "_part"), f"_part * {copies} + 1", last)
    bare = few.unionByName(many).withColumn("pos", F.lit(None).cast("bigint"))
    placed = known.where("pos IS NOT NULL").select(*record, "pos", F.lit(None).cast("bigint").alias("msg_copy"))
    return placed.unionByName(bare)
