import pytest
from pyspark.sql import functions as F

from tidelog.functions.clock import event_time, from_micros, leading_time, micros, normal_time, time_of_day
from tidelog.functions.levels import level_color, level_order
from tidelog.functions.text import file_instance, log_level, log_message, log_timestamp


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


LEVELS = {
    "10:00:00.000 [pool-1] ERROR app.Main - x": "ERROR",
    "10:00:00.000 [pool-1] WARN  app.Main - x": "WARN",
    "": "",
    "10:00:00.000 [pool-1] SEVERE app.Main - low DEBUG here": "DEBUG",
    "10:00:00.000 [pool-1] info app.Main - x": "",
    "10:00:00.000 [pool-1]ERROR app.Main - x": "",
    "10:00:00.000\t[pool-1]\tERROR\tapp.Main": "",
    "10:00:00.000 [a] INFO app - ERROR": "INFO",
    "ERROR": "ERROR",
    "first  INFO": "INFO",
    "[ERROR] WARN,": "",
    "x ERROR\n": "",
    "DEBUG\nERROR WARN": "WARN",
}


def test_level_is_the_first_valid_token(spark):
    assert column(spark, LEVELS, log_level) == list(LEVELS.values())


MESSAGES = [
    # line, full, reference
    ("10:00:00.000 [a] INFO app - hello", "hello", "hello"),
    ("no separator at all", "no separator at all", "no separator at all"),
    ("a - b - c", "b - c", "c"),
    ("a - b - ", "b -", "b"),
    (" - ", "", None),
    ("a - \t padded \x01", "padded", "padded"),
    ("", "", ""),
    ("a -  - ", "-", "a"),
    ("a - - ", "-", "-"),
    ("a -    ", "", ""),
    ("x - s%]s,+2k|D}K7b/X&@7\"", "s%]s,+2k|D}K7b/X&@7\"", "s%]s,+2k|D}K7b/X&@7\""),
    ("a -  kept ", " kept ", " kept "),
]


def test_message_modes(spark):
    texts = [m[0] for m in MESSAGES]
    assert column(spark, texts, log_message) == [m[1] for m in MESSAGES]
    assert column(spark, texts, lambda c: log_message(c, "reference")) == [m[2] for m in MESSAGES]
    with pytest.raises(ValueError):
        log_message(F.col("t"), "other")


def test_timestamp_is_the_first_match(spark):
    texts = ["x 22:23:19.384 y 10:00:00.000", "none", "10:00:00.1234", "99:99:99.999", "10:00:00,123"]
    assert column(spark, texts, log_timestamp) == ["22:23:19.384", "", "10:00:00.123", "99:99:99.999", ""]


def test_leading_time(spark):
    texts = {
        "11:44:27.233 rest": "11:44:27.233",
        "11:44:27 rest": "11:44:27.000",
        "11:44 rest": "11:44:00.000",
        "11:44:27.5 rest": "11:44:27.500",
        "11:44:27.123456789 rest": "11:44:27.123456789",
        "11:44:27.123400 rest": "11:44:27.1234",
        "99:99:99.999 rest": None,
        "24:00:00.000": None,
        " 11:44:27.233": None,
        "11:44:27.1234567890 x": None,
        "": None,
        "11:44:27.233": "11:44:27.233",
    }
    assert column(spark, texts, leading_time) == list(texts.values())
    assert column(spark, ["10:00:00.000|x"], lambda c: leading_time(c, "|")) == ["10:00:00.000"]


def test_normal_time_agrees_with_the_column(spark):
    bounds = ["08:00", "08:00:01", "08:00:01.5", "08:00:01.123450", "23:59:59.999999999"]
    assert column(spark, bounds, time_of_day) == [normal_time(b) for b in bounds]
    assert sorted(bounds) == sorted(bounds, key=normal_time)
    with pytest.raises(ValueError):
        normal_time("8:00")


def test_file_instance(spark):
    names = {"output1.log": 1, "output10.log": 10, "output.log": None, "output3.log.gz": None, "a7.log": 7}
    assert column(spark, names, file_instance) == list(names.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_event_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        df = spark.sql("SELECT '2024-03-10' AS d, '02:30:00.123456' AS t UNION ALL SELECT '2024-13-01', '01:00:00'")
        timed = df.select(event_time(F.col("d"), F.col("t")).alias("ts"))
        us = timed.withColumn("us", micros(timed, "ts"))
        back = us.withColumn("back", from_micros(us, "ts", "us"))
        rows = back.selectExpr("CAST(ts AS string) ts", "us", "CAST(back AS string) back").collect()
        assert [tuple(r) for r in rows] == [
            ("2024-03-10 02:30:00.123456", 1710037800123456, "2024-03-10 02:30:00.123456"),
            (None, None, None),
        ]
        zoned = spark.sql("SELECT timestamp_micros(1710037800123456) AS ts")
        assert zoned.select(micros(zoned, "ts")).first()[0] == 1710037800123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_level_colours_and_order(spark):
    assert column(spark, ["WARN", "INFO", "other"], level_color) == ["#f64740", "#453643", None]
    assert column(spark, ["WARN", "INFO", "other"], level_order) == [0, 5, None]
