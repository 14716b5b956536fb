import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.clock import normal_time
from tidelog.operators import select
from tidelog.operators.positions import assign_dates, line_numbers

TIMES = [
    "11:44:27.233", "11:44:27.289", "11:44:28.133", "11:44:29.343", "11:44:29.554",
    "11:44:30.122", "11:44:30.435", "11:44:31.434", "11:44:32.555",
]


@pytest.fixture
def nine(lines):
    return lines(*[("output1.log", f"{t} [worker-{i}] WARN  app.Job - step {i}") for i, t in enumerate(TIMES)])


def times(df):
    return [r.tod for r in df.collect()]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("11:44:27", "11:44:27.999", TIMES[:2]),
        ("11:44:30.500", "11:44:30.999", []),
        ("11:50:30.500", "11:50:30.999", []),
        ("11:44:27.233", "11:44:32.555", TIMES),
        ("11:44:29.343", "11:44:29.343", TIMES[3:4]),
        ("11:44:29.344", "11:44:29.343", []),
        ("11:44", "11:45", TIMES),
    ],
)
def test_time_window(nine, start, end, expected):
    assert times(select.time_window(nine, start, end)) == expected


def test_time_window_is_the_plain_filter_in_stable_order(spark, lines):
    rng = random.Random(3)
    stamps = [f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:00.{rng.randrange(4):03d}" for _ in range(400)]
    raw = lines(*[(f"output{rng.randrange(3)}.log", f"{t} x") for t in stamps])
    rows = raw.collect()
    for _ in range(6):
        start, end = rng.choice(stamps), rng.choice(stamps)
        want = sorted((r.value[:12], r.file_name, r.pos) for r in rows if start <= r.value[:12] <= end)
        got = [(r.tod, r.file_name, r.pos) for r in select.time_window(raw, start, end).collect()]
        assert got == want


def test_lines_without_time_are_set_aside(lines):
    raw = lines(("f", "10:00:00.000 a"), ("f", "stack trace"), ("f", ""))
    assert [r.value for r in select.untimed(raw).collect()] == ["stack trace", ""]
    assert select.time_window(raw, "00:00", "23:59:59.999999999").count() == 1


def test_window_per_file(lines):
    raw = lines(*[(f"output{i}.log", "10:30:00.000 x") for i in (1, 2, 10)])
    windows = [("10:00", "11:00")] + [("00:00", "01:00")] * 8 + [("10:30", "10:30")]
    assert {r.file_name for r in select.file_time_window(raw, windows).collect()} == {"output1.log", "output10.log"}
    assert select.file_time_window(raw, windows, single=True).count() == 3
    with pytest.raises(Exception, match="no time window for file output10.log"):
        select.file_time_window(raw, windows[:9]).collect()
    with pytest.raises(ValueError):
        select.file_time_window(raw, [])


def test_resume_is_strictly_after_the_mark(spark, lines):
    raw = lines(
        ("output1.log", "10:00:00.000 a"),
        ("output1.log", "10:00:00.000 b"),
        ("output1.log", "10:00:00.000 c"),
        ("output1.log", "10:00:01.000 d"),
        ("output2.log", "09:59:59.999 e"),
        ("output2.log", "10:00:00.000 f"),
        ("output3.log", "09:00:00.000 g"),
        ("output3.log", "10:30:00.000 h"),
    )
    marks = spark.createDataFrame(
        [("output1.log", "10:00:00.000", 1), ("output3.log", "08:00:00.000", 0)],
        "file_name string, last_tod string, last_pos bigint",
    )
    left = select.resume_after_mark(raw, marks, [("10:00", "11:00")], single=True)
    assert [r.value[-1] for r in left.collect()] == ["c", "f", "d", "h"]
    new_marks = select.resume_marks(left)
    assert {tuple(r) for r in new_marks.collect()} == {
        ("output1.log", "10:00:01.000", 3), ("output2.log", "10:00:00.000", 5), ("output3.log", "10:30:00.000", 7),
    }
    assert select.resume_after_mark(raw, new_marks, [("10:00", "11:00")], single=True).count() == 0


def test_levels_and_search(spark):
    rows = [("ERROR", "Disk 100% full"), ("INFO", "disk_ok"), ("WARN", "DISK slow"), ("INFO", None)]
    df = spark.createDataFrame(rows, "log_type string, log_message string")
    assert select.filter_levels(df).count() == 4
    assert select.filter_levels(df, ["WARN", "INFO"]).count() == 3
    assert select.search(df, "  DiSk ").count() == 3
    assert select.search(df, "0% F").count() == 1
    assert select.search(df, "disk_").count() == 1
    assert select.search(df, "  ").count() == 4
    assert select.search(df, "disk", ["INFO"]).count() == 1
    assert [r.log_message for r in select.error_rows(df).collect()] == ["Disk 100% full"]


def test_first_rows_and_json(spark):
    df = spark.range(100).select((100 - F.col("id")).alias("event_ts"), F.col("id").cast("string").alias("log_id"))
    first = select.first_rows(df)
    assert [r.event_ts for r in first.collect()] == list(range(1, 16))
    assert select.json_rows(select.first_rows(df, 1)).first().json == '{"event_ts":1,"log_id":"99"}'


def test_line_numbers_over_blocks_and_files(spark):
    rng = random.Random(5)
    rows = [(f"f{rng.choice('abbbbb')}", p) for p in rng.sample(range(100_000), 3000)]
    df = spark.createDataFrame(rows, "file_name string, pos bigint").repartition(7)
    got = line_numbers(df, block=16).orderBy("line_no").collect()
    assert [(r.file_name, r.pos) for r in got] == sorted(rows)
    assert [r.line_no for r in got] == list(range(3000))
    restarted = line_numbers(df, block=16, per_file=True).orderBy("file_name", "pos").collect()
    in_a = sum(r.file_name == "fa" for r in restarted)
    assert [r.line_no for r in restarted] == [*range(in_a), *range(3000 - in_a)]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_dates_roll_over_at_midnight(spark, block):
    clock = ["22:00:00.000", "23:59:59.999", None, "00:00:00.001", "11:00:00.000", "10:59:00.000", "23:00:00.000",
             None, "01:00:00.000", "23:30:00.000", "00:10:00.000"]
    days = [1, 1, None, 2, 2, 2, 2, None, 3, 3, 4]
    rows = [("a", i, t) for i, t in enumerate(clock)] + [("b", 5, "12:00:00.000")]
    df = spark.createDataFrame(rows, "file_name string, pos bigint, tod string").withColumn("first_day", F.lit("2024-02-28"))
    out = assign_dates(df, block=block).orderBy("file_name", "pos").collect()
    want = [d and f"2024-{'02' if d < 3 else '03'}-{27 + d if d < 3 else d - 2:02d}" for d in days]
    assert [str(r.event_ts)[:10] if r.event_ts else None for r in out[:-1]] == want
    assert str(out[-1].event_ts) == "2024-02-28 12:00:00"
    assert normal_time("12:00") == out[-1].tod
