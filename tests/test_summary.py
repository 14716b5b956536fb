import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelog.operators.alerts import batch_alerts
from tidelog.operators.merge import latest_per_key
from tidelog.operators.ranges import nested_ranges, range_bucket
from tidelog.operators.splits import fold_parts, holdout_split, kfold_split
from tidelog.operators.summary import length_profile, level_counts, pattern_rate
from tidelog.schema import LEVEL_RANGES


def test_level_counts_lists_only_levels_present(spark):
    df = spark.createDataFrame([("WARN", 5), ("INFO", 2), ("WARN", 3)], "log_type string, n int")
    rows = {r.id: r for r in level_counts(df, order="n").collect()}
    assert set(rows) == {"WARN", "INFO"}
    assert (rows["WARN"].value, rows["WARN"].first_seen, rows["WARN"].color, rows["WARN"].ord) == (2, 3, "#f64740", 0)


@pytest.mark.parametrize("errors, alerts", [(0, 0), (2, 0), (3, 1), (4, 1)])
def test_alert_needs_three_errors(spark, errors, alerts):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=i), "f", i, "ERROR", f"<m{i}> & 'x'") for i in reversed(range(errors))]
    rows.append((start, "f", 99, "INFO", "fine"))
    df = spark.createDataFrame(
        rows, "event_ts timestamp_ntz, file_name string, src_pos bigint, log_type string, log_message string"
    )
    got = batch_alerts(df).collect()
    assert len(got) == alerts
    if alerts:
        assert (got[0].n_errors, got[0].message1, got[0].message3) == (errors, "<m0> & 'x'", "<m2> & 'x'")
        assert got[0].body.startswith("<p>&lt;m0&gt; &amp; &#39;x&#39;</p><p>&lt;m1&gt;")


def test_alert_keeps_only_first_rows_before_its_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "id AS src_pos", "'f' AS file_name", "TIMESTAMP_NTZ'2024-01-01' AS event_ts", "'ERROR' AS log_type",
        "string(id) AS log_message", "id % 2 AS part",
    )
    plan = batch_alerts(df, by=("part",))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = batch_alerts(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_range_bucket_takes_the_first_range_at_a_shared_edge(spark):
    values = {0.0: "ERROR", 0.005: "ERROR", 0.01: "ERROR", 0.0100001: "WARN", 0.2: "WARN", 0.25: "DEBUG",
              0.3: "DEBUG", 1.0: "INFO", 1.5: "INFO", -1.0: "INFO"}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(range_bucket(F.col("v"))).collect()] == list(values.values())
    shuffled = random.Random(1).sample(LEVEL_RANGES, len(LEVEL_RANGES))
    assert df.select(range_bucket(F.col("v"), shuffled).alias("a")).collect() == df.select(
        range_bucket(F.col("v")).alias("a")
    ).collect()


@pytest.mark.parametrize("seed", range(4))
def test_nested_and_overlapping_ranges_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    spans = [(float(lo), float(lo + rng.choice([0, 0, 1, 2, 5, 30]))) for lo in [rng.randrange(60) for _ in range(70)]]
    rows = nested_ranges(spark.createDataFrame(spans, "lo double, hi double")).collect()
    known = set(spans)
    assert {(r.lo, r.hi) for r in rows} == known and len(rows) == len(known)
    for r in rows:
        others = known - {(r.lo, r.hi)}
        assert r.is_nested == any(r.lo >= a and r.hi <= b for a, b in others), r
        assert r.is_overlapping == any(r.lo < b and a < r.hi for a, b in others), r
        earlier = [(b, -a) for a, b in others if a < r.lo or (a == r.lo and b > r.hi)]
        best = max(earlier, default=None)
        assert (r.reach_hi, r.reach_lo) == ((best[0], -best[1]) if best else (None, None)), r


def test_touching_ranges_do_not_overlap(spark):
    df = spark.createDataFrame([(lo, hi) for _, lo, hi in LEVEL_RANGES], "lo double, hi double")
    assert nested_ranges(df).where("is_nested OR is_overlapping").count() == 0


def test_profiles(spark):
    rows = [("a", "x" * 10), ("a", "y" * 51), ("a", "tab\there ok"), ("b", "ae0bf1cg2af3be0 z"), ("b", None)]
    df = spark.createDataFrame(rows, "log_type string, log_message string")
    got = {r.log_type: r for r in length_profile(df, by=("log_type",)).collect()}
    assert (got["a"].min_length, got["a"].max_length, got["a"].n_bad_length, got["a"].n_bad_symbols) == (10, 51, 1, 1)
    rate = {r.log_type: (r.n_rows, r.n_hits, r.hit_rate) for r in pattern_rate(df, by=("log_type",)).collect()}
    assert rate == {"a": (3, 0, 0.0), "b": (2, 1, 0.5)}
    assert pattern_rate(df).first().n_rows == 5


@pytest.mark.parametrize("start, stop, limit", [(1, 3, 0), (2, 4, 25), (1, 10, 7), (5, 60, 10_000)])
def test_holdout_follows_the_running_count(spark, start, stop, limit):
    rng = random.Random(7)
    users = [rng.choice([1, 1, 1, 2, 3, 4, 5, 6]) for _ in range(300)]
    seen, taken, want = {}, 0, []
    for user in users:
        seen[user] = seen.get(user, 0) + 1
        hit = start <= seen[user] <= stop and (limit <= 0 or taken < limit)
        taken += hit
        want.append(hit)
    df = spark.createDataFrame(list(enumerate(users)), "pos bigint, user bigint").repartition(5)
    got = holdout_split(df, "user", "pos", start, stop, limit).orderBy("pos").collect()
    assert [r.is_test for r in got] == want


@pytest.mark.parametrize("limit", [0, 3])
def test_holdout_of_tied_positions_and_missing_ones(spark, limit):
    rows = [("u", p, f"i{k}") for k, p in enumerate((10, 20, 20, 20, 30))] + [("v", 20, "x"), ("v", 20, "x"), ("v", 20, "x")]
    rows += [(None, 1, "n"), ("u", None, "n")]
    df = spark.createDataFrame(rows, "user string, pos bigint, item string")
    found = [sorted(map(tuple, holdout_split(df.repartition(k), "user", "pos", 1, 2, limit).collect()), key=repr) for k in (1, 4)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    hits = [r for r in found[0] if r[3]]
    assert [r[:2] for r in hits if r[0] == "u"] == [("u", 10), ("u", 20)]
    assert sum(r[0] == "v" for r in hits) == (2 if limit == 0 else 1)


def test_folds(spark):
    df = spark.range(10).select(F.col("id").alias("pos"), (-F.col("id")).cast("string").alias("item"))
    folds = kfold_split(df, "pos", 4)
    assert [r.fold for r in folds.orderBy("pos").collect()] == [1] * 4 + [2] * 4 + [3] * 2
    sparse = kfold_split(df.withColumn("pos", F.col("pos") * 53), "pos", 4)
    assert [r.fold for r in sparse.orderBy("pos").collect()] == [1] * 4 + [2] * 4 + [3] * 2
    base, test = fold_parts(folds, 2, order=("item",))
    assert [r.item for r in test.collect()] == ["-7", "-6", "-5", "-4"]
    assert base.count() == 6 and base.intersect(test).count() == 0


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "log_id string, version int, text string")
    assert {tuple(r) for r in latest_per_key(df).collect()} == {("a", 3, "z"), ("b", 1, None)}
