import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.functions.clock import leading_time
from tidelog.operators.select import file_time_window, time_window, untimed
from tidelog.sources import timeindex
from tidelog.sources.loglines import _Settings, scan_logs
from tidelog.sources.timeindex import (
    _TimedReader,
    _Wanted,
    index_logs,
    leading_times,
    seek_file_windows,
    seek_time_window,
    seek_untimed,
    timed_logs,
)

WINDOWS = [("00:00", "23:59:59.999999999"), ("10:00", "10:30"), ("23:50", "23:59:59"), ("12:00", "11:00"), ("00:00", "00:00")]


def log(seed, lines, first=0, step=20.0, ends="\n"):
    """Lines whose clock goes on, over midnight if it must, slightly out of order and with lines
    that have no time, odd bytes, and times of every precision."""
    rng, out, clock = random.Random(seed), [], float(first)
    for n in range(lines):
        clock += rng.random() * step
        at = max(0.0, clock - rng.random() * 3) % 86400
        whole = f"{int(at) // 3600:02d}:{int(at) // 60 % 60:02d}"
        form = rng.randrange(12)
        text = whole if form == 0 else f"{whole}:{int(at) % 60:02d}"
        if form > 1:
            text += f".{int(at % 1 * 1000):03d}" + ("4500" if form == 2 else "")
        out.append({3: "\tat some.Class", 4: "", 5: f"x{text} no time"}.get(form, f"{text} [t] INFO  a - {n} 日"))
    data = ends.join(out).encode() + ends.encode()
    return data.replace(b"- 7 ", b"- \xff ")


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "output1.log").write_bytes(log(1, 900, 8 * 3600))
    (folder / "output2.log").write_bytes(log(2, 900, 20 * 3600, ends="\r\n") + b"10:10:00.000 [t] open")
    (folder / "output3.log").write_bytes(log(3, 900, 0, 400.0))
    (folder / "output4.log").write_bytes(b"")
    (folder / "output5.log").write_bytes(b"no time\n\n\n")
    return folder


def rows_of(df):
    return sorted((r.file_name, r.pos, r.value, r.tod) for r in df.collect())


def agrees(spark, folder, index, windows=WINDOWS):
    for window in windows:
        found = rows_of(seek_time_window(spark, str(folder), str(index), *window, ordered=False))
        assert found == rows_of(time_window(scan_logs(spark, str(folder)), *window, ordered=False))


def planned(folder, index, names=".*", **wanted):
    settings = _Settings.of({"path": str(folder), "filenameregex": names})
    reader = _TimedReader(settings, str(index), " ", _Wanted(**wanted))
    return sum(task.size for task in reader.partitions())


def test_times_are_those_of_the_expression(spark):
    texts = [None, "", "10:00", "10:00 x", "10:00:01", "10:00:01.5 x", "10:00:01.123", "10:00:01.123456789 x", "24:00 x"]
    texts += ["10:00:01.1234567890 x", "10:00:01.100000 x", "x 10:00", "10:00\tx", "10:00:01.123x", "\n10:00 x", "10:00\n", "1:00 x"]
    for separator in (" ", "|", "]."):
        given = [t and t.replace(" ", separator) for t in texts]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
        want = [r[0] for r in df.orderBy("i").select(leading_time(F.col("t"), separator)).collect()]
        assert leading_times(pa.array(given, pa.string()), separator).to_pylist() == want
    assert leading_times(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("granule, split", [(1, 50), (300, 1000), (4000, 1 << 20), (1 << 20, 1 << 20)])
def test_seek_equals_scan(spark, logs, tmp_path, granule, split):
    index = tmp_path / "index"
    agrees(spark, logs, index, WINDOWS[:2])  # no index yet: files are read whole
    index_logs(spark, str(logs), str(index), granule_bytes=granule, splitBytes=split)
    agrees(spark, logs, index)


def test_granules_lie_side_by_side_and_stop_at_midnight(spark, logs, tmp_path):
    index_logs(spark, str(logs), str(tmp_path / "index"), granule_bytes=3000, splitBytes=7000)
    rows = spark.read.parquet(str(tmp_path / "index")).orderBy("file_name", "start").collect()
    for name in ("output1.log", "output2.log", "output3.log", "output5.log"):
        mine = [r for r in rows if r.file_name == name]
        data = (logs / name).read_bytes()
        assert [r.start for r in mine] == [0, *(r.stop for r in mine[:-1])]
        assert mine[-1].stop == data.rfind(b"\n") + 1
        assert all(data[r.stop - 1 : r.stop] == b"\n" for r in mine)
    # a granule of 3,000 bytes spans no half day here, unless midnight were inside
    assert all(r.greatest[:2] >= "20" or r.least[:2] < "12" for r in rows if r.file_name == "output2.log" and r.least)
    assert [(r.least, r.untimed) for r in rows if r.file_name == "output5.log"] == [(None, 3)]
    assert not [r for r in rows if r.file_name == "output4.log"]


def test_a_clock_that_jumps_at_every_line_does_not_cut_every_line(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "output1.log").write_text("".join(f"{'23' if n % 2 else '00'}:00:00.000 {n}\n" for n in range(2000)))
    index_logs(spark, str(logs), str(tmp_path / "index"), granule_bytes=8000)
    assert spark.read.parquet(str(tmp_path / "index")).count() <= 6
    agrees(spark, logs, tmp_path / "index", [("22:00", "23:59"), ("00:00", "00:00")])


def test_fewer_bytes_are_planned_for_smaller_windows(spark, tmp_path):
    logs, index = tmp_path / "logs", tmp_path / "index"
    logs.mkdir()
    for n in (1, 2, 3):
        (logs / f"output{n}.log").write_bytes(log(n, 5000, 0, 34.0))
    whole = sum(f.stat().st_size for f in logs.iterdir())
    assert planned(logs, index) == whole
    index_logs(spark, str(logs), str(index), granule_bytes=2000)
    sizes = [planned(logs, index, least="10:00:00.000", greatest=end) for end in ("10:01:00.000", "11:00:00.000", "16:00:00.000")]
    assert sizes[0] < whole // 40 and sizes[0] < sizes[1] < sizes[2] < whole // 2
    assert planned(logs, index) == whole
    assert planned(logs, index, least="11:00:00.000", greatest="10:00:00.000") == 0
    assert planned(logs, index, "output2") == (logs / "output2.log").stat().st_size
    assert 0 < planned(logs, index, untimed=True) <= whole


def test_lines_that_come_later_are_found_and_indexed_alone(spark, logs, tmp_path):
    index = tmp_path / "index"
    index_logs(spark, str(logs), str(index), granule_bytes=500)
    before = spark.read.parquet(str(index)).count()
    with (logs / "output2.log").open("ab") as file:  # goes on with the open line
        file.write(b" now closed\r\n10:05 [t] later\r\n")
    with (logs / "output1.log").open("ab") as file:
        file.write(log(9, 300, 10 * 3600))
    (logs / "output6.log").write_bytes(log(6, 300, 9 * 3600))
    agrees(spark, logs, index)
    index_logs(spark, str(logs), str(index), granule_bytes=500)
    rows = spark.read.parquet(str(index))
    assert rows.agg(F.max("generation")).first()[0] == 0
    covered = {r[0]: r[1] for r in rows.groupBy("file_name").agg(F.sum(F.col("stop") - F.col("start"))).collect()}
    assert covered == {f.name: f.stat().st_size for f in logs.iterdir() if f.stat().st_size}
    agrees(spark, logs, index)
    after = rows.count()
    index_logs(spark, str(logs), str(index), granule_bytes=500)
    assert spark.read.parquet(str(index)).count() == after > before


@pytest.mark.parametrize("kind", ["shorter", "same size", "longer", "granules twice"])
def test_replaced_files_are_read_whole_until_indexed_anew(spark, logs, tmp_path, kind):
    index, file = tmp_path / "index", logs / "output1.log"
    index_logs(spark, str(logs), str(index), granule_bytes=500)
    data = file.read_bytes()
    if kind == "granules twice":
        spark.read.parquet(str(index)).write.mode("append").parquet(str(tmp_path / "copy"))
        spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(str(index))
    else:
        middle = data[:600] + data[600:].replace(b"0", b"1")
        file.write_bytes({"shorter": data[:2000], "same size": middle, "longer": log(77, 1500, 9 * 3600)}[kind])
        os.utime(file, ns=(1, file.stat().st_mtime_ns + 10**9))
    agrees(spark, logs, index)
    index_logs(spark, str(logs), str(index), granule_bytes=500)
    agrees(spark, logs, index)
    assert planned(logs, index, "output1", least="10:00:00.000", greatest="10:01:00.000") < file.stat().st_size // 2


def test_a_window_does_not_touch_other_granules(spark, tmp_path):
    """Lines outside of the window are overwritten in place; only a scan sees it."""
    logs, index, file = tmp_path / "logs", tmp_path / "index", tmp_path / "logs" / "output1.log"
    logs.mkdir()
    file.write_text("".join(f"{n // 60:02d}:{n % 60:02d}:00.000 line {n:04d}\n" for n in range(1440)))
    index_logs(spark, str(logs), str(index), granule_bytes=1000)
    window = ("10:00", "10:59")
    want = rows_of(time_window(scan_logs(spark, str(logs)), *window))
    assert len(want) == 60
    data, stamp = bytearray(file.read_bytes()), file.stat().st_mtime_ns
    at = data.index(b"20:00:00.000")
    data[at : at + 12] = b"10:30:00.000"
    file.write_bytes(bytes(data))
    os.utime(file, ns=(stamp, stamp))
    assert len(rows_of(time_window(scan_logs(spark, str(logs)), *window))) == 61
    assert rows_of(seek_time_window(spark, str(logs), str(index), *window)) == want


def test_windows_by_file(spark, logs, tmp_path):
    index, windows = tmp_path / "index", [("10:00", "11:00"), ("23:00", "23:59"), ("00:00", "06:00"), ("10:00", "11:00"), WINDOWS[0]]
    index_logs(spark, str(logs), str(index), granule_bytes=700)
    want = file_time_window(scan_logs(spark, str(logs)), windows)
    found = seek_file_windows(spark, str(logs), str(index), windows)
    keys = [(r.tod, r.file_name, r.pos) for r in found.collect()]
    assert keys == sorted(keys) == [(r.tod, r.file_name, r.pos) for r in want.collect()] and keys
    one = seek_file_windows(spark, str(logs), str(index), windows[:1], single=True)
    assert rows_of(one) == rows_of(file_time_window(scan_logs(spark, str(logs)), windows[:1], single=True))
    with pytest.raises(Exception, match="no time window for file"):
        seek_file_windows(spark, str(logs), str(index), windows[:2]).collect()
    with pytest.raises(ValueError):
        seek_file_windows(spark, str(logs), str(index), [("10:00", "1 pm")])


def test_untimed_and_all_lines_in_one_query(spark, logs, tmp_path):
    index = tmp_path / "index"
    index_logs(spark, str(logs), str(index), granule_bytes=200)
    scanned, lines = scan_logs(spark, str(logs)), timed_logs(spark, str(logs), str(index))
    bare = sorted((r.file_name, r.pos, r.value) for r in untimed(scanned).collect())
    for found in (seek_untimed(spark, str(logs), str(index)), lines.where("tod is null"), lines.where("tod <=> null")):
        assert sorted((r.file_name, r.pos, r.value) for r in found.collect()) == bare
    # filters on one DataFrame never narrow what another use of it reads
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        late, early = lines.where("tod > '23'"), lines.where("tod < '01'")
        assert late.unionByName(early).count() == late.count() + early.count() > 0
        assert lines.count() == scanned.count()
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_granules_are_bounded_in_number(spark, logs, tmp_path, monkeypatch):
    monkeypatch.setattr(timeindex, "MOST_GRANULES", 10)
    reader = timeindex._IndexReader(_Settings.of({"path": str(logs), "chunkBytes": "1"}), str(tmp_path / "index"), " ")
    whole = sum(f.stat().st_size for f in logs.iterdir())
    assert {task.granule for task in reader.partitions()} == {-(-whole // 10)}


def test_a_missing_folder_is_empty(spark, tmp_path):
    index_logs(spark, str(tmp_path / "none"), str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).count() == 0
    assert timed_logs(spark, str(tmp_path / "none"), str(tmp_path / "index")).count() == 0
