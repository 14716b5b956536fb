import json

from pyspark.sql import functions as F

from tidelog.functions.envelope import decode, encode, parse_line, to_log_data

GOOD = '{"filename": "output1", "level": "INFO", "message": "B?y&C\\"C5", "timestamp": "10:17:23.002"}'


def variant(**changes):
    fields = json.loads(GOOD)
    for name, value in changes.items():
        if value is ...:
            fields.pop(name)
        else:
            fields[name] = value
    return json.dumps(fields)


CASES = {
    GOOD: True,
    variant(extra=5): True,
    variant(message="2024-01-01"): True,
    variant(message="12345"): True,
    variant(message="true"): True,
    variant(message=""): True,
    "  " + GOOD + " \n\t": True,
    variant(message="café 日本"): True,
    variant(pos="x", log_date=7): True,
    GOOD[:-1] + ', "level": "WARN"}': True,
    GOOD[:-1] + ', "level": null}': False,
    GOOD[:-1] + ', "_digest": "x"}': True,
    GOOD[:-1] + ', "a": NaN}': False,
    GOOD[:-1] + ', "a": 01}': False,
    GOOD + ',{"_digest":"x"}] junk': False,
    GOOD + ',{"_digest":"x"}': False,
    "5": False,
    "[]": False,
    "{}": False,
    variant(message=5): False,
    variant(message=None): False,
    variant(message=...): False,
    variant(message={"a": 1}): False,
    variant(message=["a"]): False,
    variant(message=True): False,
    variant(message=1.5): False,
    '{"sdf": "sdf"}': False,
    "[" + GOOD + "]": False,
    GOOD + " trailing": False,
    GOOD + "] junk": False,
    GOOD + ', "x"] junk': False,
    GOOD + ', "x"': False,
    GOOD + GOOD: False,
    GOOD + "," + GOOD: False,
    GOOD.replace('"', "'"): False,
    GOOD[:-1]: False,
    "": False,
    "null": False,
    '"text"': False,
    "not json": False,
    None: False,
}


def test_strict_decode(spark):
    texts = [(i, t) for i, t in enumerate(CASES)]
    df = spark.createDataFrame(texts, "i int, value string")
    rows = decode(df).orderBy("i").collect()
    wrong = [(r.value, r.valid) for r, want in zip(rows, CASES.values()) if r.valid != want]
    assert wrong == []
    first = rows[0]
    assert (first.filename, first.level, first.message, first.timestamp) == (
        "output1", "INFO", 'B?y&C"C5', "10:17:23.002",
    )
    assert all(r.filename is None and r.message is None for r in rows if not r.valid)


def test_one_parse_per_row_even_below_a_filter(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    plan = decode(df).where("valid").select("level", "message")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_decode_round_trip(spark, lines):
    raw = lines(
        ("output1.log", '10:00:00.000 [a] INFO  app - quote " slash \\ tab \t amp & é'),
        ("output1.log", "no time, no level"),
        ("output2.log", ""),
    )
    records = parse_line(raw, keep=("pos",))
    sent = records.select(encode(extras=("pos",)).alias("value"))
    back = decode(sent).where("valid").drop("value", "valid", "log_date")
    assert back.select(*records.columns).exceptAll(records).count() == 0
    assert back.count() == 3
    # Missing time and level travel as empty text, never as null.
    assert back.where("filename = 'output2.log'").first().asDict() == {
        "timestamp": "", "level": "", "message": "", "filename": "output2.log", "pos": 2,
    }


def test_pretty_envelope_is_the_same_object(spark, lines):
    records = parse_line(lines(("output1.log", "10:00:00.000 [a] WARN  app - m")))
    row = records.select(encode().alias("a"), encode(pretty=True).alias("b")).first()
    assert "\n" in row.b and json.loads(row.a) == json.loads(row.b)
    assert list(json.loads(row.a)) == ["timestamp", "level", "message", "filename"]


def test_log_data_keys(spark):
    base = dict(timestamp="10:00:00.000", level="INFO", message="m", filename="f")
    rows = [
        {**base, "pos": 1, "log_date": "2024-01-01"},
        {**base, "pos": 2, "log_date": "2024-01-01"},
        {**base, "pos": 1, "log_date": "2024-01-02"},
        {**base, "pos": 1, "log_date": None},
        {**base, "pos": 1, "log_date": "2024-01-01"},
        {**base, "pos": 3, "log_date": "never"},
    ]
    schema = "timestamp string, level string, message string, filename string, pos bigint, log_date string"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    out = to_log_data(df, "2023-05-05").collect()
    ids = [r.log_id for r in out]
    assert ids[0] == ids[4] and len(set(ids)) == 5
    assert str(out[0].event_ts) == "2024-01-01 10:00:00"
    assert str(out[3].event_ts) == "2023-05-05 10:00:00"
    assert out[5].event_ts is None
    later = [r.log_id for r in to_log_data(df, "2023-06-06").collect()]
    assert later[3] != ids[3] and [*later[:3], *later[4:]] == [*ids[:3], *ids[4:]]


def test_messages_without_position_use_their_place_in_the_topic(spark):
    schema = "timestamp string, level string, message string, filename string, msg_partition int, msg_offset bigint"
    same = ("10:00:00.000", "INFO", "m", "f")
    df = spark.createDataFrame([(*same, 0, 7), (*same, 1, 7), (*same, 0, 8), (*same, 0, 7)], schema)
    out = to_log_data(df)
    assert out.select("log_id").distinct().count() == 3
    assert out.where(F.col("src_pos").isNotNull()).count() == 0
