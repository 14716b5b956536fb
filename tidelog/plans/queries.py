"""Registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.clock import leading_time, with_leading_time
from tidelog.functions.envelope import decode, encode, parse_line, to_log_data
from tidelog.functions.text import file_instance, log_level, log_message, log_timestamp
from tidelog.operators import positions, ranges, select, splits, summary, windows
from tidelog.operators.alerts import batch_alerts
from tidelog.operators.anchored import anchored_windows
from tidelog.operators.intervals import container_counts, innermost_containers, range_lookup
from tidelog.operators.merge import latest_per_key
from tidelog.plans import inputs
from tidelog.plans.jobs import consolidate_logs, consume, monitor
from tidelog.schema import RATINGS
from tidelog.session import scratch_path
from tidelog.sinks.tables import upsert_rows
from tidelog.sources.loglines import scan_logs, tail_logs
from tidelog.sources.tables import delimited, log_table
from tidelog.sources.timeindex import index_logs, seek_time_window
from tidelog.sources.topic import read_messages
from tidelog.streaming.batches import Targets
from tidelog.streaming.windows import (
    AnchoredTarget,
    CountedTarget,
    anchored_action,
    changed_windows,
    counted_action,
    counted_windows,
    late_rows,
    newest_windows,
    stream_tumbling_count,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

DAY = "2024-01-01"
ANCHOR_MINUTES = 10
KEYED_MINUTES = 180
SLICE_SECONDS = 3600
SCORE_RANGES = (("low", 0.0, 5.0), ("mid", 5.0, 10.0), ("high", 10.0, 20.0), ("top", 20.0, 50.0))
# One window per producer file.
FILE_WINDOWS = tuple((f"{h:02d}:30:00", f"{h + 8:02d}:29:59.999") for h in range(12))
DAY_WINDOW = ("08:00", "17:59:59.999")
STORED_RANGE = ("2024-01-05 06:00:00", "2024-01-17 18:30:00")
NUMBER_PATTERN = "[1-3][0-9]"
STREAM_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
OTHER_DAY = "2024-01-02"
LATE_DAYS = 12
SEEK_GRANULE = 1 << 16


def _query(run: Query) -> Query:
    """Register under the function's name; a leading ``q_`` only keeps it apart
    from the operator of the same name."""
    _QUERIES[run.__name__.removeprefix("q_")] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# Parsing


@_query
def parse_level(spark, sf_dir):
    lines = inputs.log_lines(spark, sf_dir)
    return lines.select("pos", log_level(F.col("value")).alias("level"))


@_query
def parse_message_tail(spark, sf_dir):
    lines = inputs.wordy_lines(spark, sf_dir)
    return lines.select("pos", log_message(F.col("value"), "reference").alias("message"))


@_query
def parse_message_full(spark, sf_dir):
    lines = inputs.wordy_lines(spark, sf_dir)
    return lines.select("pos", log_message(F.col("value")).alias("message"))


@_query
def parse_timestamp(spark, sf_dir):
    lines = inputs.log_lines(spark, sf_dir)
    return lines.select("pos", log_timestamp(F.col("value")).alias("timestamp"))


@_query
def q_parse_line(spark, sf_dir):
    return parse_line(inputs.log_lines(spark, sf_dir), keep=("pos",))


@_query
def parse_documents(spark, sf_dir):
    """Whole documents through the parser, line breaks and separators included."""
    parsed = parse_line(inputs.document_lines(spark, sf_dir), keep=("pos",))
    return parsed.withColumn("n_chars", F.length("message"))


@_query
def q_leading_time(spark, sf_dir):
    lines = inputs.log_lines(spark, sf_dir)
    return lines.select("pos", leading_time(F.col("value")).alias("tod"))


@_query
def instance_of_file(spark, sf_dir):
    lines = inputs.log_lines(spark, sf_dir)
    return lines.groupBy("file_name", file_instance(F.col("file_name")).alias("instance")).agg(
        F.count("*").alias("n_lines")
    )


# Envelope


def _records(spark, sf_dir):
    return parse_line(inputs.log_lines(spark, sf_dir), keep=("pos",))


@_query
def encode_envelope(spark, sf_dir):
    return _records(spark, sf_dir).select("pos", encode(extras=("pos",)).alias("value"))


def _messages(spark, sf_dir):
    """Envelopes of all lines, most of them damaged in one of several ways."""
    good = F.col("value")
    ways = {
        0: F.concat(good, F.lit(" junk")),
        1: F.concat(good, F.lit(', {"a": 1}')),
        2: F.replace(good, F.lit('"level":'), F.lit('"lvl":')),
        3: F.regexp_replace(good, '"timestamp":"[^"]*"', '"timestamp":7'),
        4: F.regexp_replace(good, '"filename":"[^"]*"', '"filename":null'),
        5: F.concat(F.lit("["), good, F.lit("]")),
        6: F.replace(good, F.lit('"'), F.lit("'")),
        7: F.concat(F.lit(" "), good, F.lit("\n")),
    }
    text = good
    for way, damaged in ways.items():
        text = F.when(F.col("pos") % 10 == way, damaged).otherwise(text)
    encoded = _records(spark, sf_dir).select("pos", encode(extras=("pos",)).alias("value"))
    return encoded.select(F.col("pos").alias("msg_id"), text.alias("value"))


@_query
def decode_envelope(spark, sf_dir):
    decoded = decode(_messages(spark, sf_dir))
    return decoded.select("msg_id", "valid", "timestamp", "level", "message", "filename", "pos")


@_query
def decode_rejects(spark, sf_dir):
    return decode(_messages(spark, sf_dir)).where(~F.col("valid")).select("msg_id", "value")


@_query
def q_to_log_data(spark, sf_dir):
    encoded = _records(spark, sf_dir).select(encode(extras=("pos",)).alias("value"))
    return to_log_data(decode(encoded).where("valid"), DAY)


# Stored table


@_query
def log_table_scan(spark, sf_dir):
    path = scratch_path(spark, "log-data")
    upsert_rows(inputs.stored_rows(spark, sf_dir), path)
    return log_table(spark, path)


@_query
def upsert_log_data(spark, sf_dir):
    """One file's rows, then all rows twice over: every row is stored once."""
    rows = inputs.stored_rows(spark, sf_dir)
    path = scratch_path(spark, "log-data")
    upsert_rows(rows.where(F.col("file_name") == "output3.log"), path)
    upsert_rows(rows.unionByName(rows), path)
    upsert_rows(rows, path)
    return log_table(spark, path).groupBy("event_date").agg(
        F.count("*").alias("n_rows"),
        F.min("log_id").alias("min_id"),
        F.max("log_id").alias("max_id"),
        F.max("src_pos").alias("last_pos"),
    )


@_query
def latest_row_per_user(spark, sf_dir):
    logs = inputs.events_as_logs(inputs.table(spark, sf_dir, "events"))
    rows = logs.select("user_id", "ts", "pos", F.col("lvl").alias("log_type"), F.col("props").alias("log_message"))
    return latest_per_key(rows, "user_id", ("ts", "pos"))


@_query
def log_table_view(spark, sf_dir):
    return select.table_view(inputs.stored_rows(spark, sf_dir), with_file=True)


@_query
def consolidate(spark, sf_dir):
    return positions.line_numbers(inputs.log_lines(spark, sf_dir))


@_query
def assign_dates(spark, sf_dir):
    lines = with_leading_time(inputs.log_lines(spark, sf_dir)).withColumn("first_day", F.lit(DAY))
    return positions.assign_dates(lines).select("file_name", "pos", "event_ts")


# Selection


@_query
def error_rows(spark, sf_dir):
    return select.error_rows(inputs.stored_rows(spark, sf_dir)).select("log_id", "log_type", "log_message")


@_query
def filter_levels(spark, sf_dir):
    kept = select.filter_levels(inputs.stored_rows(spark, sf_dir), ["WARN", "SEVERE"])
    return kept.select("log_id", "log_type")


@_query
def filter_levels_empty(spark, sf_dir):
    return select.filter_levels(inputs.stored_rows(spark, sf_dir)).select("log_id", "log_type")


@_query
def search_messages(spark, sf_dir):
    found = select.search(inputs.stored_rows(spark, sf_dir), '  "K": 7 ', ["ERROR", "INFO", "SEVERE"])
    return found.select("src_pos", "log_type", "log_message")


@_query
def search_documents(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return select.search(docs, " Than ", text="text").select("doc_id", "lang")


@_query
def time_window(spark, sf_dir):
    return select.time_window(inputs.log_lines(spark, sf_dir), *DAY_WINDOW)


@_query
def time_window_order(spark, sf_dir):
    """Lines of a time window with their place in time, file and line order."""
    lines = select.time_window(inputs.log_lines(spark, sf_dir), *DAY_WINDOW, ordered=False)
    clock = F.expr("bigint(substring(value, 1, 2)) * 3600000 + bigint(substring(value, 4, 2)) * 60000")
    clock = clock + F.expr("bigint(substring(value, 7, 2)) * 1000 + bigint(substring(value, 10, 3))")
    timed = lines.select("file_name", "pos", clock.alias("ms"), F.lit(0).alias("_all"))
    order = positions.line_numbers(timed, "_all", "ms", "place", block=60_000, ties=("file_name", "pos"))
    return order.select("file_name", "pos", "place")


@_query
def stored_time_range(spark, sf_dir):
    """A closed range of event times over the written table."""
    path = scratch_path(spark, "log-data")
    upsert_rows(inputs.stored_rows(spark, sf_dir), path)
    return select.time_range(log_table(spark, path), *STORED_RANGE).drop("event_date")


@_query
def file_time_window(spark, sf_dir):
    return select.file_time_window(inputs.log_lines(spark, sf_dir), FILE_WINDOWS)


def _marks(spark, sf_dir):
    return select.resume_marks(select.time_window(inputs.log_lines(spark, sf_dir), "08:00", "12:00", ordered=False))


@_query
def resume_marks(spark, sf_dir):
    return _marks(spark, sf_dir)


@_query
def resume_after_mark(spark, sf_dir):
    lines = inputs.log_lines(spark, sf_dir)
    return select.resume_after_mark(lines, _marks(spark, sf_dir), [DAY_WINDOW], single=True)


@_query
def first_n_json(spark, sf_dir):
    rows = inputs.stored_rows(spark, sf_dir).drop("event_ts")
    return select.json_rows(select.first_rows(rows, order=("timestamp", "log_id")))


# Counts and windows


@_query
def level_counts(spark, sf_dir):
    """Raw lines to the pie of levels."""
    records = parse_line(inputs.log_lines(spark, sf_dir), keep=("pos",))
    return summary.level_counts(records, "level", order="pos")


@_query
def level_counts_stored(spark, sf_dir):
    return summary.level_counts(inputs.stored_rows(spark, sf_dir))


@_query
def tumbling_count(spark, sf_dir):
    return windows.tumbling_count(inputs.stored_rows(spark, sf_dir), SLICE_SECONDS, "ERROR")


@_query
def q_anchored_windows(spark, sf_dir):
    rows = inputs.stored_rows(spark, sf_dir).select("src_pos", "event_ts")
    return anchored_windows(rows, minutes=ANCHOR_MINUTES)


@_query
def anchored_windows_by_file(spark, sf_dir):
    rows = inputs.stored_rows(spark, sf_dir).select("file_name", "src_pos", "event_ts")
    return anchored_windows(rows, minutes=KEYED_MINUTES, keys=("file_name",))


def _series(spark, sf_dir):
    rows = inputs.stored_rows(spark, sf_dir).select("log_type", "event_ts")
    return windows.level_series(anchored_windows(rows, minutes=ANCHOR_MINUTES))


@_query
def window_level_series(spark, sf_dir):
    return _series(spark, sf_dir)


@_query
def filter_series(spark, sf_dir):
    return select.filter_levels(_series(spark, sf_dir), ["ERROR", "WARNING"], "level")


@_query
def filter_level_counts(spark, sf_dir):
    counts = summary.level_counts(inputs.stored_rows(spark, sf_dir))
    return select.filter_levels(counts, ["SEVERE", "DEBUG", "WARNING"], "id")


@_query
def line_chart(spark, sf_dir):
    chart = windows.chart_series(_series(spark, sf_dir))
    return chart.select("id", "color", F.to_json("data").alias("data"))


def _alerts(spark, sf_dir):
    rows = inputs.stored_rows(spark, sf_dir)
    return batch_alerts(rows, by=(windows.epoch_window("event_ts", SLICE_SECONDS).alias("window_start"),))


@_query
def alert_batches(spark, sf_dir):
    return _alerts(spark, sf_dir).drop("body")


@_query
def alert_body(spark, sf_dir):
    return _alerts(spark, sf_dir).select("window_start", "body")


# Ranges and profiles


@_query
def range_bucket(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    bucket = ranges.range_bucket(F.col("value"), SCORE_RANGES, "other")
    return events.select("event_id", "value", bucket.alias("bucket"))


@_query
def nested_ranges(spark, sf_dir):
    spans = inputs.table(spark, sf_dir, "events").groupBy("user_id", "event_type")
    return ranges.nested_ranges(spans.agg(F.min("value").alias("lo"), F.max("value").alias("hi")))


@_query
def q_range_lookup(spark, sf_dir):
    """Prices of all lines in price ranges of all parts."""
    parts = inputs.table(spark, sf_dir, "part")
    least = F.col("p_retailprice") * F.col("p_size")
    ranges = parts.select(
        least.alias("lo"), (least + F.col("p_size") * 20).alias("hi"), F.col("p_partkey").cast("string").alias("name")
    )
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return range_lookup(lines, "l_extendedprice", ranges)


def _order_spans(spark, sf_dir):
    """From the first to the last shipping of every order."""
    lines = inputs.table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    return lines.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))


@_query
def q_container_counts(spark, sf_dir):
    return container_counts(_order_spans(spark, sf_dir))


@_query
def q_innermost_containers(spark, sf_dir):
    return innermost_containers(_order_spans(spark, sf_dir))


@_query
def pattern_rate(spark, sf_dir):
    return summary.pattern_rate(inputs.stored_rows(spark, sf_dir), pattern=NUMBER_PATTERN, by=("log_type",))


@_query
def pattern_rate_documents(spark, sf_dir):
    return summary.pattern_rate(inputs.table(spark, sf_dir, "documents"), "text", by=("lang",), pattern="[A-Z][5-9a-z][f-w]")


@_query
def length_profile(spark, sf_dir):
    return summary.length_profile(inputs.stored_rows(spark, sf_dir), by=("log_type",), shortest=9)


@_query
def length_profile_documents(spark, sf_dir):
    return summary.length_profile(inputs.table(spark, sf_dir, "documents"), "text", ("lang",), longest=2000)


# Splits


def _ratings(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("pos"), "o_totalprice")


@_query
def holdout_split(spark, sf_dir):
    return splits.holdout_split(_ratings(spark, sf_dir), "user_id", "pos", 1, 10, 1000)


@_query
def holdout_split_unlimited(spark, sf_dir):
    return splits.holdout_split(_ratings(spark, sf_dir), "user_id", "pos", 5, 7)


@_query
def kfold_split(spark, sf_dir):
    return splits.kfold_split(_ratings(spark, sf_dir), "pos", 3000)


@_query
def kfold_sparse(spark, sf_dir):
    """Folds of a key with gaps: rows are counted, not key values."""
    sparse = _ratings(spark, sf_dir).withColumn("pos", F.col("pos") * 53)
    return splits.kfold_split(sparse, "pos", 3000)


@_query
def fold_parts(spark, sf_dir):
    """Base and test part of one fold, with each row's place in its part."""
    folds = splits.kfold_split(_ratings(spark, sf_dir), "pos", 3000)
    base, test = splits.fold_parts(folds, 2)
    both = base.withColumn("part", F.lit("base")).unionByName(test.withColumn("part", F.lit("test")))
    return positions.line_numbers(both, "part", "pos", "place", per_file=True)


# Files and streams, written to and read from the shared scratch folder


@_query
def scan_log_dir(spark, sf_dir):
    path = scratch_path(spark, "logs")
    inputs.log_lines(spark, sf_dir).select("value").write.text(path)
    lines = scan_logs(spark, path, r"^part-.*\.txt$")
    return parse_line(lines).select("timestamp", "level", "message")


@_query
def delimited_read(spark, sf_dir):
    path = scratch_path(spark, "ratings")
    orders = inputs.table(spark, sf_dir, "orders")
    seconds = F.expr("(o_orderdate - TIMESTAMP_NTZ'1970-01-01 00:00:00') div INTERVAL '1' SECOND")
    rating = F.substring("o_orderpriority", 1, 1).cast("int")
    orders.select("o_custkey", "o_orderkey", rating, seconds).write.csv(path, sep="\t")
    return delimited(spark, path, RATINGS)


def _event_stream(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@_query
def stream_tumbling(spark, sf_dir):
    """All hours with errors, the open one included: each batch gives the windows it
    changed, and the last state of each counts."""
    rows = _event_stream(spark, sf_dir).where(F.col("event_type") == "error")
    counted = stream_tumbling_count(rows, SLICE_SECONDS, "0 seconds", ts="ts")
    path = scratch_path(spark, "tumbling")
    writer = counted.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint")
    writer = writer.foreachBatch(changed_windows(f"{path}/changes"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return newest_windows(spark.read.parquet(f"{path}/changes"))


@_query
def stream_late_rows(spark, sf_dir):
    """Counts per hour of all rows in three runs, of which the last brings the middle third of the
    time: what its rows behind the watermark are, by hour, and what is counted."""
    base = scratch_path(spark, "late")
    events = inputs.table(spark, sf_dir, "events")
    rows = events.select("event_id", F.col("ts").alias("event_ts"))
    first, second = [F.lit(cut).cast(rows.schema["event_ts"].dataType) for cut in STREAM_CUTS]
    at, target = F.col("event_ts"), CountedTarget(f"{base}/windows")
    for part in (at < first, at >= second, (at >= first) & (at < second)):
        rows.where(part).write.mode("append").parquet(f"{base}/rows")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/rows")
        action = counted_action(target, SLICE_SECONDS, LATE_DAYS * 86400)
        writer = stream.writeStream.foreachBatch(action).option("checkpointLocation", f"{base}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    hour = F.date_trunc("hour", "event_ts").cast(rows.schema["event_ts"].dataType).alias("window_start")
    late = late_rows(spark, target).groupBy(hour, "watermark").agg(F.count("*").alias("n_late"), F.min("event_id").alias("least_id"))
    return counted_windows(spark, target).join(late, "window_start", "full")


@_query
def stream_anchored(spark, sf_dir):
    """Three runs of one query, each after a third of the rows has come: windows that
    are open at the end of a run go on in the next."""
    base = scratch_path(spark, "anchored")
    logs = inputs.events_as_logs(inputs.table(spark, sf_dir, "events"))
    rows = logs.select(
        "file_name",
        F.col("pos").cast("string").alias("log_id"),
        F.col("ts").alias("event_ts"),
        F.col("lvl").alias("log_type"),
    )
    target = AnchoredTarget(f"{base}/windows")
    for since, until in zip((None, *STREAM_CUTS), (*STREAM_CUTS, None), strict=True):
        part = rows if since is None else rows.where(F.col("event_ts") >= F.lit(since).cast("timestamp_ntz"))
        part = part if until is None else part.where(F.col("event_ts") < F.lit(until).cast("timestamp_ntz"))
        part.write.mode("append").parquet(f"{base}/rows")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/rows")
        writer = stream.writeStream.foreachBatch(anchored_action(target, KEYED_MINUTES))
        writer = writer.option("checkpointLocation", f"{base}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target.rows).drop("batch_id", "window_end")


@_query
def stream_alert(spark, sf_dir):
    """All envelopes as one micro-batch of the consumer: its single alert."""
    base = scratch_path(spark, "alert")
    _records(spark, sf_dir).select(encode(extras=("pos",)).alias("value")).write.text(f"{base}/messages")
    targets = Targets(f"{base}/stored", f"{base}/alerts", f"{base}/rejects", day=DAY)
    messages = read_messages(spark, "folder", path=f"{base}/messages")
    consume(messages, targets, f"{base}/consume").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/alerts").drop("batch_id")


@_query
def stream_files_to_store(spark, sf_dir):
    """Log files, tailed and published, consumed and stored: all jobs in a row."""
    base = scratch_path(spark, "files-to-store")
    inputs.log_lines(spark, sf_dir).select("value").write.text(f"{base}/logs")
    publishing = monitor(
        spark,
        f"{base}/logs",
        [DAY_WINDOW],
        f"{base}/publish",
        "folder",
        names=r"^part-.*\.txt$",
        path=f"{base}/messages",
    )
    publishing.trigger(availableNow=True).start().awaitTermination()
    targets = Targets(f"{base}/stored", f"{base}/alerts", f"{base}/rejects", day=DAY)
    messages = read_messages(spark, "folder", path=f"{base}/messages")
    consume(messages, targets, f"{base}/consume").trigger(availableNow=True).start().awaitTermination()
    return log_table(spark, targets.stored).select("timestamp", "log_type", "log_message", "event_ts", "event_date")


def _consumed(spark, base, checkpoint, day):
    targets = Targets(f"{base}/stored", f"{base}/alerts", f"{base}/rejects", day=day)
    messages = read_messages(spark, "folder", path=f"{base}/messages")
    consume(messages, targets, f"{base}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()
    return log_table(spark, targets.stored)


def _plain_messages(spark, sf_dir, base):
    """Four-field envelopes without position, very many of them equal."""
    records = _records(spark, sf_dir).withColumn("timestamp", F.lit("10:00:00.000")).withColumn("message", F.lit("m"))
    records.select(encode().alias("value")).write.text(f"{base}/messages")


def _tally(rows, *by):
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.countDistinct("log_id").alias("n_keys"))


@_query
def upsert_same_text(spark, sf_dir):
    """Equal messages are all stored, and once each when they are consumed again."""
    base = scratch_path(spark, "same-text")
    _plain_messages(spark, sf_dir, base)
    _consumed(spark, base, "first", DAY)
    return _tally(_consumed(spark, base, "again", DAY), "file_name", "log_type")


@_query
def upsert_replay_other_day(spark, sf_dir):
    """The same messages dated otherwise are other rows, under other keys."""
    base = scratch_path(spark, "other-day")
    _plain_messages(spark, sf_dir, base)
    _consumed(spark, base, "first", DAY)
    _consumed(spark, base, "other", OTHER_DAY)
    return _tally(_consumed(spark, base, "again", OTHER_DAY), "event_date")


@_query
def time_seek(spark, sf_dir):
    """The day window by seeking in written logs: while the index covers the files of the first of
    two runs alone, and when it has been brought up to date."""
    base = scratch_path(spark, "seek")
    lines = inputs.log_lines(spark, sf_dir)
    logs, names = f"{base}/logs", r"^part-.*\.txt$"
    found = []
    for run in (0, 1):
        lines.where(F.col("pos") % 2 == run).select("value").sortWithinPartitions("value").write.mode("append").text(logs)
        if not run:
            index_logs(spark, logs, f"{base}/index", names, granule_bytes=SEEK_GRANULE)
    for covered in ("first", "all"):
        if covered == "all":
            index_logs(spark, logs, f"{base}/index", names, granule_bytes=SEEK_GRANULE)
        # stored, as a plan made later would see the index as it is then
        rows = seek_time_window(spark, logs, f"{base}/index", *DAY_WINDOW, names=names, ordered=False)
        rows.select("value", "tod", F.lit(covered).alias("covered")).write.parquet(f"{base}/found/{covered}")
        found.append(spark.read.parquet(f"{base}/found/{covered}"))
    return found[0].unionByName(found[1])


@_query
def time_index(spark, sf_dir):
    """The index of written logs: per file its lines without a time and its least and greatest time."""
    base = scratch_path(spark, "time-index")
    docs = inputs.document_lines(spark, sf_dir)  # of a message of several lines only the first has a time
    docs.unionByName(inputs.log_lines(spark, sf_dir)).select("value").write.text(f"{base}/logs")
    index_logs(spark, f"{base}/logs", f"{base}/index", r"^part-.*\.txt$", granule_bytes=SEEK_GRANULE)
    rows = spark.read.parquet(f"{base}/index")
    untimed, size = F.sum("untimed").alias("n_untimed"), F.sum(F.col("stop") - F.col("start")).alias("n_bytes")
    return rows.agg(untimed, size, F.min("least").alias("least"), F.max("greatest").alias("greatest"))


@_query
def consolidated_files(spark, sf_dir):
    """The consolidated writer over written log files."""
    base = scratch_path(spark, "consolidated")
    inputs.log_lines(spark, sf_dir).select("value").write.text(f"{base}/logs")
    consolidate_logs(spark, f"{base}/logs", f"{base}/all", r"^part-.*\.txt$")
    return spark.read.text(f"{base}/all")


class _TailRun:
    """Keeps a run's lines by batch; the batch after ``most`` others fails before it is kept."""

    def __init__(self, path: str, run: int, most: int | None):
        self.path, self.run, self.left = path, run, most

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.left is not None:
            self.left -= 1
            if self.left < 0:
                raise RuntimeError("this run ends here")
        rows = batch.select("value", F.lit(self.run).alias("run"))
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


@_query
def tail_backlog(spark, sf_dir):
    """A backlog read in bounded batches by three runs of one query, of which two fail in their
    third batch: how often each line was read, in how many runs, and whether no batch was larger
    than the limit (and, as lines are read whole, a line of each file)."""
    base = scratch_path(spark, "backlog")
    lines = inputs.log_lines(spark, sf_dir).select("value")
    lines.write.text(f"{base}/logs")
    size = F.octet_length("value") + 1
    whole, longest = lines.agg(F.sum(size), F.max(size)).first()
    limit = max(1, whole // 12)
    tail = tail_logs(spark, f"{base}/logs", r"^part-.*\.txt$", maxBytesPerTrigger=limit, checkpointLocation=f"{base}/tail")
    for run, most in enumerate((2, 2, None)):
        kept = _TailRun(f"{base}/rows", run, most)
        query = tail.writeStream.foreachBatch(kept).option("checkpointLocation", f"{base}/tail").start()
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            if most is None:
                raise
        query.stop()
    read = spark.read.parquet(f"{base}/rows")
    files = spark.read.text(f"{base}/logs").select(F.col("_metadata.file_name").alias("name")).distinct().count()
    largest = read.groupBy("batch_id").agg(F.sum(size).alias("bytes")).agg(F.max("bytes")).first()[0]
    found = read.groupBy("value").agg(F.count("*").alias("times"))
    runs = read.select("run").distinct().count()
    return found.select(
        "value", "times", F.lit(runs).alias("runs"), F.lit(largest <= limit + files * longest).alias("bounded")
    )


@_query
def tail_restart(spark, sf_dir):
    """Files that come between two runs of one monitor: every line once."""
    base = scratch_path(spark, "restart")
    lines = inputs.log_lines(spark, sf_dir)
    for part in (0, 1):
        lines.where(F.col("pos") % 2 == part).select("value").write.mode("append").text(f"{base}/logs")
        publishing = monitor(
            spark, f"{base}/logs", [DAY_WINDOW], f"{base}/publish", "folder", names=r"^part-.*\.txt$", path=f"{base}/messages"
        )
        publishing.trigger(availableNow=True).start().awaitTermination()
    stored = _consumed(spark, base, "consume", DAY)
    return stored.select("timestamp", "log_type", "log_message", "event_ts")
