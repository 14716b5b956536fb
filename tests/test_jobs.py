import json

import pytest
from pyspark.sql import functions as F

from tidelog.operators.select import time_range
from tidelog.plans.jobs import consolidate_logs, consume, dashboard, monitor
from tidelog.sinks.tables import compact_date, store, upsert_rows, write_batch
from tidelog.sources.tables import log_table
from tidelog.sources.topic import read_messages
from tidelog.streaming.batches import Targets, batch_action, numbered_copies
from tidelog.streaming.windows import (
    AnchoredTarget,
    CountedTarget,
    anchored_action,
    counted_action,
    counted_windows,
    late_rows,
    stream_tumbling_count,
)


def envelope(second, level="INFO", message="m", file="output1.log", pos=0, **more):
    return json.dumps(
        {"timestamp": f"10:00:{second:02d}.000", "level": level, "message": message, "filename": file, "pos": pos, **more}
    )


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def targets(base, **more):
    return Targets(str(base / "stored"), str(base / "alerts"), str(base / "rejects"), day="2024-01-01", **more)


def test_upsert_keeps_one_row_per_key(spark, tmp_path):
    batch = messages(spark, [envelope(1, pos=0), envelope(1, pos=1), envelope(1, pos=0)])
    act = batch_action(targets(tmp_path))
    act(batch, 0)
    act(batch, 0)
    act(batch.union(messages(spark, [envelope(2, pos=2)])), 1)
    rows = log_table(spark, str(tmp_path / "stored"))
    assert sorted(r.src_pos for r in rows.collect()) == [0, 1, 2]
    assert {r.event_date for r in rows.collect()} == {"2024-01-01"}


def test_rows_without_event_time_are_stored_once(spark, tmp_path):
    batch = messages(spark, [envelope(1).replace("10:00:01.000", "soon"), envelope(3, pos=4)])
    act = batch_action(targets(tmp_path))
    act(batch, 0)
    act(batch, 1)
    rows = {r.event_date: r for r in log_table(spark, str(tmp_path / "stored")).collect()}
    assert set(rows) == {"undated", "2024-01-01"} and rows["undated"].event_ts is None
    assert log_table(spark, str(tmp_path / "stored")).count() == 2


def test_equal_messages_without_position_are_all_stored(spark, tmp_path):
    same = json.dumps({"timestamp": "10:00:00.000", "level": "INFO", "message": "m", "filename": "f"})
    odd = json.dumps({"timestamp": "10:00:00.000", "level": "INFO", "message": "m", "filename": "f", "pos": "x"})
    act = batch_action(targets(tmp_path))
    for batch_id in (0, 0, 1):
        act(messages(spark, [same] * 3 + [odd] * 2), batch_id)
    rows = log_table(spark, str(tmp_path / "stored"))
    assert rows.count() == 10 == rows.select("log_id").distinct().count()


def test_copies_are_numbered_without_gaps_in_parts(spark):
    schema = "msg_file string, timestamp string, level string, message string, filename string, log_date string, pos bigint"
    kinds = {"hot": 1000, "two": 2, "one": 1, "full": 16, "over": 17, None: 5}
    rows = [("f", "t", "INFO", text, "n", None, None) for text, n in kinds.items() for _ in range(n)]
    rows += [("g", "t", "INFO", "hot", "n", None, None)] * 3 + [("f", "t", "INFO", "hot", "n", None, 7)]
    found = numbered_copies(spark.createDataFrame(rows, schema).repartition(3), 0, copies=16)
    got = {}
    for r in found.collect():
        got.setdefault((r.msg_file, r.message, r.pos), []).append(r.msg_copy)
    want = {("f", text, None): list(range(1, n + 1)) for text, n in kinds.items()}
    want |= {("g", "hot", None): [1, 2, 3], ("f", "hot", 7): [None]}
    assert {key: sorted(numbers) if key[2] is None else numbers for key, numbers in got.items()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan


def test_a_batch_writes_only_the_parts_it_has(spark, tmp_path):
    act = batch_action(targets(tmp_path))
    act(messages(spark, []), 0)
    assert not list(tmp_path.iterdir())
    act(messages(spark, ["bad"]), 1)
    assert [p.name for p in tmp_path.iterdir()] == ["rejects"]
    act(messages(spark, [envelope(1)]), 2)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["rejects", "stored"]


def test_replay_under_another_day_never_repeats_a_key(spark, tmp_path):
    texts = [json.dumps({"timestamp": f"10:00:0{i}.000", "level": "INFO", "message": "m", "filename": "f"}) for i in range(2)]
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        goal = Targets(str(tmp_path / "stored"), str(tmp_path / "alerts"), str(tmp_path / "rejects"), day=day)
        batch_action(goal)(messages(spark, texts), 0)
    rows = log_table(spark, str(tmp_path / "stored"))
    assert rows.count() == 4 == rows.select("log_id").distinct().count()


def test_only_the_asked_dates_are_listed(spark, tmp_path):
    rows = times(spark, "f", [(str(i), i * 86400.0) for i in range(30)])
    wide = rows.selectExpr("log_id", "file_name", "'' timestamp", "log_type", "'' log_message", "event_ts", "0L src_pos")
    upsert_rows(wide, str(tmp_path / "t"))
    assert len(log_table(spark, str(tmp_path / "t")).inputFiles()) == 30
    assert len(log_table(spark, str(tmp_path / "t"), ["2024-01-03"]).inputFiles()) == 1
    assert log_table(spark, str(tmp_path / "t"), ["2031-01-01"]).count() == 0
    assert log_table(spark, str(tmp_path / "t"), []).count() == 0


def test_compacting_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        rows = times(spark, "f", [(f"{i}-{k}", float(k)) for k in range(5)])
        upsert_rows(
            rows.selectExpr("log_id", "file_name", "'' timestamp", "log_type", "'' log_message", "event_ts", "0L src_pos"), path
        )
    before = sorted(map(tuple, log_table(spark, path).collect()))
    compact_date(spark, path, "2024-01-01")
    after = log_table(spark, path)
    assert sorted(map(tuple, after.collect())) == before and len(after.inputFiles()) == 1


def test_batch_of_rejects_only(spark, tmp_path):
    act = batch_action(targets(tmp_path))
    act(messages(spark, ["nonsense", "{}"]), 0)
    act(messages(spark, ["nonsense", "{}"]), 0)
    act(messages(spark, []), 1)
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "rejects")).collect()) == ["nonsense", "{}"]
    assert log_table(spark, str(tmp_path / "stored")).count() == 0


@pytest.mark.parametrize("errors, alerts", [(2, 0), (3, 1), (4, 1)])
def test_one_alert_per_batch(spark, tmp_path, errors, alerts):
    texts = [envelope(i, "ERROR", f"e{i}", pos=i) for i in range(errors)] + [envelope(9, pos=99), "bad"]
    act = batch_action(targets(tmp_path))
    act(messages(spark, texts), 5)
    act(messages(spark, texts), 5)
    folder = tmp_path / "alerts" / "batch_id=5"
    assert folder.exists() == bool(alerts)
    if alerts:
        got = spark.read.parquet(str(folder)).collect()
        assert len(got) == 1
        assert (got[0].n_errors, got[0].message1, got[0].message2, got[0].message3) == (errors, "e0", "e1", "e2")


def test_first_errors_follow_arrival_order_of_a_topic(spark, tmp_path):
    rows = [(envelope(i, "ERROR", f"e{i}"), i % 2, 10 - i) for i in range(4)]
    df = spark.createDataFrame(rows, "value string, msg_partition int, msg_offset bigint")
    batch_action(targets(tmp_path))(df, 0)
    got = spark.read.parquet(str(tmp_path / "alerts")).first()
    assert (got.message1, got.message2, got.message3) == ("e2", "e0", "e3")


def test_unknown_store_fails_before_any_query(tmp_path):
    for kind in ("local", "elsewhere"):
        with pytest.raises(ValueError, match="unsupported store"):
            store(kind)
        with pytest.raises(ValueError, match="unsupported store"):
            batch_action(targets(tmp_path, kind=kind))


def test_write_batch_replaces_its_own_folder(spark, tmp_path):
    for _ in range(2):
        write_batch(spark.range(3), str(tmp_path / "t"), 7)
    write_batch(spark.range(2), str(tmp_path / "t"), 8)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_upsert_reads_only_the_batch_dates_and_time_range(spark, tmp_path):
    from tidelog.operators.merge import new_rows, reach
    from tidelog.sources.tables import with_event_date

    rows = times(spark, "f", [(str(i), i * 3600.0) for i in range(72)])
    wide = rows.selectExpr("log_id", "file_name", "'' timestamp", "log_type", "'' log_message", "event_ts", "0L src_pos")
    upsert_rows(wide, str(tmp_path / "t"))
    assert log_table(spark, str(tmp_path / "t")).count() == 72
    batch = with_event_date(wide.where("log_id IN ('30', '31')"))
    span = reach(batch)
    near = log_table(spark, str(tmp_path / "t"), span["parts"])
    assert all("event_date=2024-01-02" in path for path in near.inputFiles()) and near.inputFiles()
    fresh = new_rows(batch, near, span)
    assert fresh.count() == 0
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan and "2024-01-02" in plan and "GreaterThanOrEqual(event_ts" in plan


def test_time_range_prunes_dates_and_row_groups(spark, tmp_path):
    rows = times(spark, "f", [(str(i), i * 3600.0) for i in range(100)])
    wide = rows.selectExpr("log_id", "file_name", "'' timestamp", "log_type", "'' log_message", "event_ts", "0L src_pos")
    upsert_rows(wide, str(tmp_path))
    found = time_range(log_table(spark, str(tmp_path)), "2024-01-02 03:00:00", "2024-01-03 01:00:00")
    assert sorted(int(r.log_id) for r in found.collect()) == list(range(27, 50))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_ts" in plan


def test_dates_go_on_over_midnight_and_restarts_and_untimed_lines_are_set_aside(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    goal = targets(tmp_path)

    def run(*texts, name="output1.log"):
        with open(logs / name, "a") as f:
            f.writelines(f"{text}\n" for text in texts)
        publishing = monitor(
            spark, str(logs), [("00:00", "23:59:59.999")], str(tmp_path / "publish"), "folder",
            day="2024-01-01", names=".*", untimed=str(tmp_path / "untimed"), path=str(tmp_path / "messages"),
        )
        publishing.trigger(availableNow=True).start().awaitTermination()

    run("23:59:58.000 [w] INFO app - a", "\tat some.Class", "23:59:59.000 [w] INFO app - b")
    run("00:00:01.000 [w] INFO app - c", "22:00:00.000 [w] INFO app - d")
    run("03:00:00.000 [w] INFO app - r", name="app.2024-03-05.log")
    run("01:00:00.000 [w] INFO app - e", "caused by")
    stream = read_messages(spark, "folder", path=str(tmp_path / "messages"))
    consume(stream, goal, str(tmp_path / "consume")).trigger(availableNow=True).start().awaitTermination()
    found = {r.log_message: str(r.event_ts) for r in log_table(spark, goal.stored).collect()}
    assert found == {
        "a": "2024-01-01 23:59:58", "b": "2024-01-01 23:59:59", "c": "2024-01-02 00:00:01",
        "d": "2024-01-02 22:00:00", "r": "2024-03-05 03:00:00", "e": "2024-01-03 01:00:00",
    }
    aside = spark.read.parquet(str(tmp_path / "untimed")).collect()
    assert sorted((r.file_name, r.value) for r in aside) == [("output1.log", "\tat some.Class"), ("output1.log", "caused by")]


def test_pipeline_restarts_without_loss_or_repeats(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    goal = targets(tmp_path)

    def write(name, *rows):
        with open(logs / name, "a") as f:
            f.writelines(f"{t} [w] {level} app - {text}\n" for t, level, text in rows)

    def run():
        publishing = monitor(
            spark, str(logs), [("10:00", "10:59:59")], str(tmp_path / "publish"), "folder",
            day="2024-01-01", path=str(tmp_path / "messages"),
        )
        publishing.trigger(availableNow=True).start().awaitTermination()
        stream = read_messages(spark, "folder", path=str(tmp_path / "messages"))
        consume(stream, goal, str(tmp_path / "consume")).trigger(availableNow=True).start().awaitTermination()
        rows = log_table(spark, goal.stored).collect()
        return sorted((r.file_name, r.log_message, r.log_type, str(r.event_ts)) for r in rows)

    write("output1.log", ("09:59:59.999", "INFO", "early"), ("10:00:00.000", "ERROR", "a - b"))
    first = [("output1.log", "a - b", "ERROR", "2024-01-01 10:00:00")]
    assert run() == first
    assert run() == first
    write("output1.log", ("10:00:00.000", "ERROR", "a - b"), ("10:30:00.500", "SEVERE", "odd"))
    write("output2.log", ("10:00:01.000", "ERROR", "x"), ("11:00:00.000", "INFO", "late"))
    second = sorted([
        *first,
        ("output1.log", "a - b", "ERROR", "2024-01-01 10:00:00"),
        ("output1.log", "odd", "", "2024-01-01 10:30:00.500000"),
        ("output2.log", "x", "ERROR", "2024-01-01 10:00:01"),
    ])
    assert run() == second
    # All messages again under a new checkpoint: a consumer that lost its progress.
    stream = read_messages(spark, "folder", path=str(tmp_path / "messages"))
    consume(stream, goal, str(tmp_path / "consume-again")).trigger(availableNow=True).start().awaitTermination()
    assert run() == second


def test_consolidate(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for i in (2, 1):
        (logs / f"output{i}.log").write_text("".join(f"file {i} line {n}\n" for n in range(50)))
    for _ in range(2):
        consolidate_logs(spark, str(logs), str(tmp_path / "all"))
    parts = sorted((tmp_path / "all").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text == "".join(f"file {i} line {n}\n" for i in (1, 2) for n in range(50))


def stream_of(spark, path, rows):
    """Write rows as one more file of a folder."""
    rows.coalesce(1).write.mode("append").parquet(str(path))


def times(spark, name, pairs):
    df = spark.createDataFrame(pairs, "log_id string, second double")
    ts = F.expr("TIMESTAMP_NTZ'2024-01-01' + INTERVAL '0.000001' SECOND * bigint(second * 1000000)")
    return df.select(F.lit(name).alias("file_name"), "log_id", ts.alias("event_ts"), F.lit("INFO").alias("log_type"))


@pytest.mark.parametrize("keys", [("file_name",), ()])
def test_anchored_windows_carry_over_batches(spark, tmp_path, keys):
    folder, target = tmp_path / "in", AnchoredTarget(str(tmp_path / "out"))
    schema = times(spark, "f", [("x", 0.0)]).schema

    def run():
        rows = spark.readStream.schema(schema).parquet(str(folder))
        writer = rows.writeStream.foreachBatch(anchored_action(target, 1, keys))
        writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        got = spark.read.parquet(target.rows).collect()
        return {(r.file_name, r.log_id): (r.window_idx, r.is_late, str(r.window_start)[11:]) for r in got}

    stream_of(spark, folder, times(spark, "f", [("b", 59.0), ("a", 0.0), ("c", 61.0)]))
    stream_of(spark, folder, times(spark, "g", [("a", 500.0)]))
    first = run()
    assert first[("f", "a")] == (0, False, "00:00:00") and first[("f", "b")][0] == 0 and first[("f", "c")][0] == 1
    stream_of(spark, folder, times(spark, "f", [("e", 121.000001), ("d", 121.0), ("late", 30.0), ("z", 900.0)]))
    stream_of(spark, folder, times(spark, "h", [("a", 5000.0)]))
    second = run()
    if keys:
        assert second[("f", "d")] == (1, False, "00:01:01")
        assert second[("f", "late")] == (1, True, "00:01:01")
        assert second[("f", "e")] == (2, False, "00:02:01.000001")
        assert second[("f", "z")] == (3, False, "00:15:00")
        assert second[("g", "a")] == (0, False, "00:08:20")
        assert second[("h", "a")] == (0, False, "01:23:20")
    else:
        assert {second[("f", x)] for x in ("d", "e", "late")} == {(2, True, "00:08:20")}
        assert second[("f", "z")] == (3, False, "00:15:00") and second[("h", "a")][0] == 4
    stream_of(spark, folder, times(spark, "g", [("b", 560.0), ("c", 570.0), ("old", 1.0)]))
    third = run()
    if keys:
        assert [third[("g", x)][:2] for x in ("b", "c", "old")] == [(0, False), (1, False), (0, True)]


def test_anchored_batches_equal_one_run(spark, tmp_path):
    """Rows that come in time order give the same windows in any cut into batches."""
    import random

    from tidelog.operators.anchored import anchored_windows

    rng = random.Random(4)
    seconds = sorted(rng.choice([rng.uniform(0, 400), rng.uniform(3000, 9000)]) for _ in range(300))
    pairs = [(str(i), s) for i, s in enumerate(seconds)]
    act = anchored_action(AnchoredTarget(str(tmp_path)), 1, ())
    for batch_id, (lo, hi) in enumerate([(0, 7), (7, 100), (100, 101), (101, 300)]):
        for _ in range(1 + batch_id % 2):
            act(times(spark, "f", pairs[lo:hi]), batch_id)
    got = {r.log_id: r.window_idx for r in spark.read.parquet(f"{tmp_path}/rows").collect()}
    whole = {r.log_id: r.window_idx for r in anchored_windows(times(spark, "f", pairs)).collect()}
    assert got == whole


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_streamed_tumbling_counts_drop_and_count_late_rows(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    folder, out = tmp_path / "in", str(tmp_path / "out")
    schema = times(spark, "f", [("x", 0.0)]).schema
    dropped = 0
    try:
        for batch in ([("a", 1.0), ("b", 5.0)], [("c", 100.0)], [("late", 2.0), ("d", 101.0)], [("e", 300.0)]):
            stream_of(spark, folder, times(spark, "f", batch))
            rows = spark.readStream.schema(schema).parquet(str(folder))
            counted = stream_tumbling_count(rows, 10, "20 seconds")
            writer = counted.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
            query = writer.format("parquet").option("path", out).trigger(availableNow=True).start()
            query.awaitTermination()
            for progress in query.recentProgress:
                dropped += sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        got = {str(r.window_start)[11:]: r.n_logs for r in spark.read.parquet(out).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {"00:00:00": 2, "00:01:40": 2}
    assert dropped == 1


BATCHES = [
    [("a", 1.0), ("b", 5.0), ("none", None)],
    [("c", 100.0), ("early", 3.0)],  # the watermark is that of earlier batches
    [("late", 2.0), ("d", 101.0), ("just", 79.999999), ("open", 80.0)],
    [],
    [("e", 300.0), ("again", 2.0), ("again", 2.0), ("in", 89.0)],
    [("last", 89.0), ("none", None)],
]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_late_rows_are_kept_and_counted(spark, tmp_path, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    target = CountedTarget(str(tmp_path))
    act = counted_action(target, 10, 20, "ERROR")
    try:
        for batch_id, batch in enumerate(BATCHES):
            data = [(i, "ERROR", s) for i, s in batch] + [("other", "INFO", 9999.0)]
            made = spark.createDataFrame(data, "id string, log_type string, s double")
            at = F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("bigint"))
            if kind == "timestamp_ntz":
                at = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, cast(s as decimal(18, 6)))")
            for _ in range(1 + batch_id % 2):  # a batch that is run again changes nothing
                act(made.select("id", "log_type", at.alias("event_ts")), batch_id)
        counts = counted_windows(spark, target)
        seconds = F.unix_micros(F.col("window_start").cast("timestamp")) / 1_000_000
        if kind == "timestamp_ntz":
            seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', window_start)")
        got = {int(r.at): r.n_logs for r in counts.select(seconds.alias("at"), "n_logs").collect()}
        late = sorted((r.id, r.batch_id, r.watermark is None) for r in late_rows(spark, target).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # batch 2 has the watermark 80, batch 4 that of 81, batch 5 that of 280
    assert got == {0: 3, 80: 2, 100: 2, 300: 1}
    want = [("again", 4, False), ("again", 4, False), ("just", 2, False), ("last", 5, False), ("late", 2, False)]
    assert late == [*want, ("none", 0, True), ("none", 5, False)]
    assert sum(got.values()) + len(late) == sum(map(len, BATCHES))


def test_late_rows_are_those_that_spark_drops(spark, tmp_path):
    import random

    rng = random.Random(3)
    folder, target = tmp_path / "in", CountedTarget(str(tmp_path / "own"))
    schema = times(spark, "f", [("x", 0.0)]).schema
    act, dropped, n = counted_action(target, 10, 20), 0, 0
    for batch_id in range(4):
        batch = [(str(i), batch_id * 30 + rng.uniform(-60, 30) + 60) for i in range(40)]
        n += len(batch)
        rows = times(spark, "f", batch)
        act(rows, batch_id)
        stream_of(spark, folder, rows)
        counted = stream_tumbling_count(spark.readStream.schema(schema).parquet(str(folder)), 10, "20 seconds")
        writer = counted.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
        query = writer.format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    own = {r.window_start: r.n_logs for r in counted_windows(spark, target).collect()}
    final = {r.window_start: r.n_logs for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert final and final.items() <= own.items()
    late = late_rows(spark, target).collect()
    # Spark drops what was aggregated before it meets the state: at most as many as there are rows
    assert 0 < dropped <= len(late) and sum(own.values()) + len(late) == n


def test_dashboard(spark):
    rows = times(spark, "f", [("a", 0.0), ("b", 30.0), ("c", 90.0)]).select(
        "log_id", "file_name", F.date_format("event_ts", "HH:mm:ss.SSS").alias("timestamp"),
        F.when(F.col("log_id") == "a", "ERROR").otherwise("INFO").alias("log_type"),
        F.concat(F.lit("Message "), "log_id").alias("log_message"), "event_ts", F.lit(0).alias("src_pos"),
    )
    views = dashboard(rows, ["INFO"], " MESSAGE b")
    assert [(r.id, r.value) for r in views["pie"].collect()] == [("INFO", 2)]
    assert sorted((r.x, r.level, r.y) for r in views["lines"].collect()) == [("0", "INFO", 1), ("1", "INFO", 1)]
    assert [r.log_message for r in views["table"].collect()] == ["Message b"]
    everything = dashboard(rows)
    assert everything["lines"].count() == 12 and everything["table"].count() == 3
