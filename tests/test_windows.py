import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import anchored
from tidelog.operators.anchored import anchored_windows, resumed_windows, window_openings
from tidelog.operators.windows import chart_series, level_series, tumbling_count

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def fold(times, length):
    """The definition, one event after another."""
    out, until, idx = [], None, -1
    for t in times:
        if until is None or t > until:
            until, idx = t + length, idx + 1
        out.append(idx)
    return out


def at_seconds(spark, seconds, **more):
    """Rows at the given (fractional) seconds after 2024-01-01."""
    data = [(i, round(s * 1_000_000), *[v[i] for v in more.values()]) for i, s in enumerate(seconds)]
    kinds = "".join(f", {name} string" for name in more)
    df = spark.createDataFrame(data, f"n int, us bigint{kinds}")
    ts = F.expr(f"{EPOCH} + INTERVAL '0.000001' SECOND * us")
    return df.withColumn("event_ts", F.when(F.col("us").isNotNull(), ts))


def windows_of(df, **options):
    return [r.window_idx for r in anchored_windows(df, **options).orderBy("n").collect()]


def test_window_end_is_inclusive(spark):
    df = at_seconds(spark, [0, 59, 60, 61, 130, 150])
    assert windows_of(df) == [0, 0, 0, 1, 2, 2]
    assert windows_of(at_seconds(spark, [0, 60.000001])) == [0, 1]
    assert windows_of(at_seconds(spark, [5])) == [0]
    assert windows_of(at_seconds(spark, [0, 7200, 7200, 90000.5])) == [0, 1, 1, 2]


def test_input_order_does_not_matter_and_times_may_precede_1970(spark):
    seconds = [-3e9, 150, 61, -3e9 + 60, 0, 130, 60, -3e9 + 61, 59]
    assert windows_of(at_seconds(spark, seconds)) == [0, 4, 3, 0, 2, 4, 2, 1, 2]


def test_window_bounds(spark):
    row = anchored_windows(at_seconds(spark, [0, 90]), minutes=1).orderBy("n").collect()[1]
    assert (str(row.window_start), str(row.window_end)) == ("2024-01-01 00:01:30", "2024-01-01 00:02:30")
    with pytest.raises(ValueError):
        window_openings(at_seconds(spark, [0]), minutes=0)


def test_rows_without_time_get_no_window(spark):
    df = at_seconds(spark, [0, 1]).unionByName(
        spark.createDataFrame([(9, None, None)], "n int, us bigint, event_ts timestamp_ntz")
    )
    assert windows_of(df) == [0, 0, None]


# How the planner may join: by broadcast, by sorting, and with skew handling that
# would split any partition it is allowed to.
JOINS = {
    "broadcast": {},
    "sorted": {"spark.sql.autoBroadcastJoinThreshold": "-1"},
    "skewed": {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100",
    },
}


@pytest.mark.parametrize(
    "stream, join, minutes",
    [(1 << 20, "sorted", 1), (1 << 20, "skewed", 0.05), (200, "broadcast", 1), (60, "skewed", 30), (0, "sorted", 30)],
)
def test_few_and_many_times_keys_and_a_hot_key(spark, monkeypatch, stream, join, minutes):
    monkeypatch.setattr(anchored, "STREAM_ROWS", stream)
    monkeypatch.setattr(anchored, "SLICE_ROWS", 150)
    rng = random.Random(stream)
    keys = [rng.choice("aaaabcd") for _ in range(1500)]
    # Gaps, a crowded minute and repeated times.
    seconds = [
        rng.choice([rng.uniform(0, 60), rng.uniform(0, 9000), rng.uniform(2e5, 2.1e5), float(rng.randrange(4000))])
        for _ in keys
    ]
    df = at_seconds(spark, seconds, k=keys).repartition(5)
    for name, value in JOINS[join].items():
        spark.conf.set(name, value)
    try:
        by_key = anchored_windows(df, minutes=minutes, keys=("k",)).collect()
        overall = anchored_windows(df, minutes=minutes).collect()
    finally:
        for name in JOINS[join]:
            spark.conf.unset(name)
    length = round(minutes * 60_000_000)
    for rows, groups in ((overall, [None]), (by_key, "abcd")):
        assert len(rows) == len(keys)
        for group in groups:
            mine = sorted((r.us, r.window_idx) for r in rows if group in (None, r.k))
            assert [w for _, w in mine] == fold([t for t, _ in mine], length)


def follower(times, length):
    return [next((u for u in times if u > t + length), None) for t in times]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-300, 300), min_size=1, max_size=80, unique=True).map(sorted), st.integers(1, 60))
def test_slices_give_every_time_its_follower(spark, monkeypatch, times, length):
    monkeypatch.setattr(anchored, "SLICE_ROWS", 9)
    df = spark.createDataFrame([("a", t) for t in times] + [("b", times[0])], "k string, us bigint")
    found = {(r.k, r.us): r.nxt for r in anchored._followers(df, length).collect()}
    want = {("a", t): u for t, u in zip(times, follower(times, length), strict=True)}
    assert found == want | {("b", times[0]): None}


def test_one_crowded_hour_is_many_slices_of_like_size(spark, monkeypatch):
    """All times within a third of one window: no task has more than a few of them."""
    monkeypatch.setattr(anchored, "SLICE_ROWS", 1000)
    stored = {}
    write = anchored.written_table

    def seen(df, label):
        stored[label] = write(df, label)
        return stored[label]

    monkeypatch.setattr(anchored, "written_table", seen)
    df = spark.range(20_000).select(F.lit("a").alias("k"), (F.col("id") * 180_000).alias("us"))
    assert anchored._followers(df, 180 * anchored.MINUTE).where("nxt is not null").count() == 0
    sizes = [r["count"] for r in stored["time-slices"].groupBy("_slice").count().collect()]
    assert len(sizes) >= 35 and max(sizes) <= 2_500


def test_many_times_go_on_from_an_open_window(spark, monkeypatch):
    rng = random.Random(5)
    seconds = sorted(rng.choice([rng.uniform(0, 600), rng.uniform(0, 9000)]) for _ in range(600))
    df = at_seconds(spark, seconds, k=["a"] * 600)
    whole = {r.n: r.window_idx for r in anchored_windows(df, keys=("k",)).collect()}
    monkeypatch.setattr(anchored, "STREAM_ROWS", 10)
    monkeypatch.setattr(anchored, "SLICE_ROWS", 50)
    carried = spark.createDataFrame([], anchored.CARRIED)
    found = {}
    for part in (df.where("n < 250"), df.where("n >= 250")):
        rows, carried = resumed_windows(part, carried, keys=("k",))
        found |= {r.n: r.window_idx for r in rows.collect()}
    assert found == whole


def test_level_series_is_dense(spark):
    df = at_seconds(spark, [0, 10, 61, 200], log_type=["ERROR", "INFO", "ERROR", "odd"])
    series = level_series(anchored_windows(df))
    rows = {(r.x, r.level): r.y for r in series.collect()}
    assert len(rows) == 3 * 6
    assert {k: v for k, v in rows.items() if v} == {("0", "ERROR"): 1, ("0", "INFO"): 1, ("1", "ERROR"): 1}
    chart = {r.id: [(p.x, p.y) for p in r.data] for r in chart_series(series).collect()}
    assert chart["ERROR"] == [("0", 1), ("1", 1), ("2", 0)]
    assert chart["WARNING"] == [("0", 0), ("1", 0), ("2", 0)]


def test_tumbling_count_is_epoch_aligned(spark):
    df = at_seconds(spark, [0, 9.999999, 10, 35], log_type=["ERROR", "ERROR", "INFO", "ERROR"])
    got = {(str(r.window_start)[-8:], r.n_logs) for r in tumbling_count(df, 10, "ERROR").collect()}
    assert got == {("00:00:00", 2), ("00:00:30", 1)}
    assert tumbling_count(df, 7).agg(F.sum("n_logs")).first()[0] == 4
