import pytest

from tidelog.schema import RATINGS, USERS
from tidelog.sources.loglines import _last_offset, scan_logs, tail_logs
from tidelog.sources.tables import delimited
from tidelog.sources.topic import message_sender, read_messages, topic_options

TEXT = b"a\nbb\r\n\nccc\xff\n\xe6\x97\xa5\xe6\x9c\xac\nlast"
ROWS = [(0, "a"), (2, "bb"), (6, ""), (7, "ccc�"), (12, "日本"), (19, "last")]


def rows_of(df):
    return sorted((r.file_name, r.pos, r.value) for r in df.collect())


@pytest.mark.parametrize("split, chunk", [(1, 1), (2, 3), (5, 2), (7, 100), (1 << 20, 1 << 20)])
def test_scan_gives_the_same_rows_for_any_split(spark, tmp_path, split, chunk):
    (tmp_path / "output1.log").write_bytes(TEXT)
    (tmp_path / "output2.log").write_bytes(b"")
    (tmp_path / "output3.log").write_bytes(b"\n\nx\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "output4.log").write_bytes(b"not here\n")
    got = rows_of(scan_logs(spark, str(tmp_path), splitBytes=split, chunkBytes=chunk))
    want = [("output1.log", p, v) for p, v in ROWS]
    want += [("output3.log", 0, ""), ("output3.log", 1, ""), ("output3.log", 2, "x")]
    assert got == want


def test_number_of_ranges_is_bounded(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"output{i}.log").write_text("".join(f"line {n}\n" for n in range(500)))
    whole = rows_of(scan_logs(spark, str(tmp_path)))
    few = scan_logs(spark, str(tmp_path), splitBytes=1, maxRanges=6)
    assert few.rdd.getNumPartitions() <= 8
    assert rows_of(few) == whole and len(whole) == 1000


def test_scan_of_a_missing_folder_is_empty(spark, tmp_path):
    assert scan_logs(spark, str(tmp_path / "none")).count() == 0


def test_scan_filters_names(spark, tmp_path):
    for name in ("output1.log", "notes.txt"):
        (tmp_path / name).write_text("x\n")
    assert [r.file_name for r in scan_logs(spark, str(tmp_path), r"\.log$").collect()] == ["output1.log"]


class Tail:
    """Runs the tail until it has caught up; each call is a restart."""

    def __init__(self, spark, base, **options):
        self.spark, self.base, self.options = spark, base, options
        self.logs = base / "logs"
        self.logs.mkdir()
        self.batches = []

    def __call__(self, stop=None):
        lines = tail_logs(self.spark, str(self.logs), **self.options)
        writer = lines.writeStream.option("checkpointLocation", str(self.base / "checkpoint"))
        writer = writer.format("parquet").option("path", str(self.base / "rows"))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        self.batches += [p["numInputRows"] for p in query.recentProgress]
        return rows_of(self.spark.read.parquet(str(self.base / "rows")))

    def append(self, name, text):
        with open(self.logs / name, "a") as f:
            f.write(text)


def test_tail_reads_appends_new_files_and_whole_lines_once(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    tail.append("output1.log", "one\ntw")
    tail.append("other.txt", "ignored\n")
    assert tail() == [("output1.log", 0, "one")]
    assert tail() == [("output1.log", 0, "one")]
    tail.append("output1.log", "o\nthree\n")
    tail.append("output12.log", "new\n")
    want = [("output1.log", 0, "one"), ("output1.log", 4, "two"), ("output1.log", 8, "three"), ("output12.log", 0, "new")]
    assert tail() == want
    tail.append("output1.log", "four\n")
    assert tail() == sorted([*want, ("output1.log", 14, "four")])


def test_tail_starts_over_when_a_file_is_replaced(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    tail.append("output1.log", "old one\nold two\n")
    tail.append("output2.log", "same head\nx\n")
    tail()
    (tail.logs / "output1.log").write_text("a new and longer file\nthan before\nby far\n")
    (tail.logs / "output2.log").write_text("same head\n")
    got = tail()
    assert [r for r in got if r[0] == "output1.log"] == [
        ("output1.log", 0, "a new and longer file"), ("output1.log", 0, "old one"),
        ("output1.log", 8, "old two"), ("output1.log", 22, "than before"), ("output1.log", 34, "by far"),
    ]
    # A shorter file is read again from its start.
    assert [r[1:] for r in got if r[0] == "output2.log"] == [(0, "same head"), (0, "same head"), (10, "x")]


def test_tail_notices_a_replaced_file_with_the_same_head(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    tail.append("output1.log", "head\nA\nB\n")
    tail()
    (tail.logs / "output1.log").write_text("head\nNEW\nA\nB\n")
    tail.append("output2.log", "head\nsame\n")
    got = [v for name, _, v in tail() if name == "output1.log"]
    assert sorted(got) == sorted(["head", "A", "B", "head", "NEW", "A", "B"])
    (tail.logs / "output2.log").write_text("head\nSAME\n")
    assert sorted(v for name, _, v in tail() if name == "output2.log") == ["SAME", "head", "head", "same"]


def test_tail_releases_a_rested_last_line_once(spark, tmp_path):
    tail = Tail(spark, tmp_path, lastLineAfterSeconds=0)
    tail.append("output1.log", "one\ntwo")
    assert tail() == [("output1.log", 0, "one"), ("output1.log", 4, "two")]
    assert len(tail()) == 2
    tail.append("output1.log", "\nthree\n")
    want = [("output1.log", 0, "one"), ("output1.log", 4, "two"), ("output1.log", 8, "three")]
    assert tail() == want
    tail.append("output1.log", "more")
    tail()
    tail.append("output1.log", " of it\n")
    assert tail() == sorted([*want, ("output1.log", 14, "more"), ("output1.log", 18, " of it")])


def test_malformed_bytes_and_carriage_returns(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\r\ntwo\rx\n\xff\r\n\n\xc3\xa9\n")
    (tmp_path / "b.log").write_bytes(b"one\r\ntwo\rx\n\r\n\n\xc3\xa9")
    got = {(n, v) for n, _, v in rows_of(scan_logs(spark, str(tmp_path), chunkBytes=5))}
    assert {v for n, v in got if n == "a.log"} == {"one", "two\rx", "\ufffd", "", "é"}
    assert {v for n, v in got if n == "b.log"} == {"one", "two\rx", "", "é"}


def test_tail_limits_bytes_per_trigger(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "output1.log").write_text("line 0\n")
    lines = tail_logs(spark, str(logs), maxBytesPerTrigger=200)
    writer = lines.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
    query = writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    query.processAllAvailable()
    with open(logs / "output1.log", "a") as f:
        f.writelines(f"line {i}\n" for i in range(1, 100))
    query.processAllAvailable()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert max(sizes) <= 30 and len(sizes) >= 4
    assert [v for _, _, v in rows_of(spark.read.parquet(str(tmp_path / "rows")))] == [f"line {i}" for i in range(100)]


def _run_until(query_of, most):
    """Runs a tail until its batch after ``most`` fails (None: to the end); rows by batch."""
    left = [most]

    def act(batch, batch_id):
        if left[0] is not None:
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("stopped")
        batch.write.mode("overwrite").parquet(f"{query_of.rows}/batch_id={batch_id}")

    query = query_of().foreachBatch(act).start()
    try:
        query.processAllAvailable()
    except Exception:
        assert most is not None
    query.stop()


def test_a_backlog_is_read_in_bounded_batches_after_every_start(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for name in ("output1.log", "output2.log"):
        (logs / name).write_text("".join(f"{name} {i}\n" for i in range(250)))

    def start():
        tail = tail_logs(spark, str(logs), maxBytesPerTrigger=600, checkpointLocation=str(tmp_path / "checkpoint"))
        return tail.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))

    start.rows = str(tmp_path / "rows")
    for most in (2, 1, 0, None):
        _run_until(start, most)
        with open(logs / "output2.log", "a") as f:
            f.writelines(f"more {most} {i}\n" for i in range(100))
    _run_until(start, None)
    rows = spark.read.parquet(start.rows)
    per_batch = [r["count"] for r in rows.groupBy("batch_id").count().collect()]
    assert max(per_batch) <= 600 // 13 + 2 + 30 and len(per_batch) >= 12
    want = [f"{name} {i}" for name in ("output1.log", "output2.log") for i in range(250)]
    want += [f"more {most} {i}" for most in (2, 1, 0, None) for i in range(100)]
    assert sorted(r.value for r in rows.collect()) == sorted(want)


def test_the_offset_of_a_checkpoint(tmp_path):
    folder = tmp_path / "offsets"
    assert _last_offset(str(tmp_path), 0) == {}
    folder.mkdir()
    for name, text in (("9", 'v1\n{}\n{"a": 1}'), ("10", 'v1\n{"x": 2}\n{"b": 2}\n-'), (".11.crc", "x"), ("11.tmp", "y")):
        (folder / name).write_text(text)
    assert _last_offset(str(tmp_path), 0) == {"b": 2}
    assert _last_offset(str(tmp_path), 1) == {} and _last_offset(str(tmp_path), 2) is None
    (folder / "12").write_text("v2\n{}\n{}")
    assert _last_offset(str(tmp_path), 0) is None


def test_delimited(spark, tmp_path):
    (tmp_path / "ratings.tsv").write_text("196\t242\t3\t881250949\n186\t302\t3\t891717742\n")
    (tmp_path / "users.txt").write_text('1|24|M|technician|08544\n2|53|F|other|"9404\n')
    ratings = delimited(spark, str(tmp_path / "ratings.tsv"), RATINGS).collect()
    assert tuple(ratings[0]) == (196, 242, 3, 881250949) and len(ratings) == 2
    users = delimited(spark, str(tmp_path / "users.txt"), USERS, "|").collect()
    assert users[0].zip == "08544" and users[1].zip == '"9404'
    (tmp_path / "bad.tsv").write_text("x\ty\tz\tw\n")
    with pytest.raises(Exception):
        delimited(spark, str(tmp_path / "bad.tsv"), RATINGS).collect()


def test_topic_options():
    assert topic_options("b:1", "Logs") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "Logs", "startingOffsets": "earliest",
    }
    tls = topic_options("b:1", "Logs", truststore="/t.jks", maxOffsetsPerTrigger="10")
    assert tls["kafka.security.protocol"] == "SSL" and tls["maxOffsetsPerTrigger"] == "10"


def test_unknown_transport(spark, tmp_path):
    with pytest.raises(ValueError, match="transport"):
        read_messages(spark, "pigeon")
    with pytest.raises(ValueError, match="transport"):
        message_sender("pigeon", path=str(tmp_path))
