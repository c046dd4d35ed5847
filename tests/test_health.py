import datetime as dt
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions import times
from tidelog.operators import health
from tidelog.sources import days, files

BASE = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("seconds,lag_s,lag_h,status", [
    (3599, 3599, 0, "ok"), (7199, 7199, 1, "ok"), (7200, 7200, 2, "alert"), (-3601, -3601, -1, "ok")])
def test_lag(spark, seconds, lag_s, lag_h, status):
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=seconds), BASE)],
                               "collected_at timestamp, commit_time timestamp")
    assert health.lag_status(df).first()[:] == (lag_s, lag_h, status)


def test_lag_rounds_both_times_down(spark):
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=1.9), BASE + dt.timedelta(seconds=0.1))],
                               "collected_at timestamp, commit_time timestamp")
    assert health.lag_status(df).first()[:] == (1, 0, "ok")


def test_lag_without_a_time_is_an_error(spark):
    df = spark.createDataFrame([(None, BASE)], "collected_at timestamp, commit_time timestamp")
    assert health.lag_status(df).first()[:] == (None, None, "error")


def events(spark):
    data = [(s, BASE + dt.timedelta(hours=h), BASE + dt.timedelta(hours=h - lag))
            for s, h, lag in ((1, 0, 0), (9, 5, 0), (5, 30, 3), (7, 31, 0))]
    df = spark.createDataFrame(data, "seq bigint, collected_at timestamp, commit_time timestamp")
    return df.withColumn("collect_date", times.collect_date(F.col("collected_at")))


def test_resume_uses_the_newest_day(spark):
    assert health.resume_seq(events(spark)).first()[0] == 7
    assert health.resume_seq(events(spark).limit(0)).first()[0] is None
    assert health.last_valid_event(events(spark)).first().seq == 7
    assert health.lag_monitor(events(spark)).first()[:] == (0, 0, "ok")


def test_latest_day_reads_one_partition(spark, folder):
    os.makedirs(f"{folder}/e/collect_date=2026-01-01")  # a day without a file yet
    events(spark).write.mode("append").partitionBy("collect_date").parquet(f"{folder}/e")
    stored = spark.read.parquet(f"{folder}/e")
    schema = "seq bigint, collected_at timestamp, commit_time timestamp, collect_date date"
    newest = health.resume_seq(days.newest_day(spark, f"{folder}/e", schema))
    assert newest.first()[0] == 7
    plan = newest._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(collect_date" in plan
    files_read = days.newest_day(spark, f"{folder}/e", schema).inputFiles()
    assert files_read and all("collect_date=2025-01-02" in f for f in files_read)
    assert days.newest_day(spark, f"{folder}/none", schema).count() == 0
    day = days.day_partition(stored, as_of=dt.date(2025, 1, 2))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2025-01-01" in plan
    assert {r.seq for r in day.collect()} == {1, 9}


def test_open_stalls(spark):
    points = [("a", BASE), ("a", BASE + dt.timedelta(minutes=30)), ("b", BASE + dt.timedelta(minutes=35))]
    df = spark.createDataFrame(points, "type string, commit_time timestamp")
    got = health.stall_gaps(df, as_of=F.lit("2025-01-01 00:50:00").cast("timestamp"))
    assert sorted((r.source, r["to"] is None) for r in got.collect()) == [("a", False), ("a", True)]


def test_sequence_gaps(spark):
    rng = random.Random(1)
    have = sorted(rng.sample(range(1000), 700))
    want = [(a + 1, b - 1) for a, b in zip(have, have[1:]) if b - a > 1]
    df = spark.createDataFrame([(s,) for s in have + have[:50]] + [(None,)], "seq bigint")
    for width in (1, 7, 100_000):
        assert rows(health.sequence_gaps(df, width)) == want or sorted(
            tuple(r) for r in health.sequence_gaps(df, width).collect()) == want


def test_process_rejects_have_a_reason(spark):
    df = spark.createDataFrame([(h, p) for h, p, _ in EVENTS], "header string, payload string")
    got = sorted(r.reject_reason for r in health.process_state_rejects(df).collect())
    assert got == ["empty payload", "no length", "no length", "payload too long"]
    named = df.where("header like '%PROCESS_STATE_%'").count()
    assert health.process_state_filter(df).count() + len(got) == named


def test_missing_days(spark):
    got = days.missing_days(events(spark), F.lit(dt.date(2024, 12, 31)), F.lit(dt.date(2025, 1, 4)))
    assert [str(r[0]) for r in rows(got)] == ["2024-12-31", "2025-01-03", "2025-01-04"]


def brute(points, minutes):
    gaps, sessions = [], []
    for source in sorted({p[0] for p in points}):
        ts = sorted(t for s, t in points if s == source)
        start, n = ts[0], 0
        for a, b in zip([None] + ts, ts):
            if a is not None and b - a >= dt.timedelta(minutes=minutes):
                gaps.append((source, a, b))
                sessions.append((source, start, a, n))
                start, n = b, 0
            n += 1
        sessions.append((source, start, ts[-1], n))
    return sorted(gaps), sorted(sessions)


@pytest.mark.parametrize("seed", range(4))
def test_stalls_equal_a_plain_scan(spark, seed):
    rng = random.Random(seed)
    points = []
    for source in "ab":
        t = BASE
        for _ in range(60):
            t += rng.choice([dt.timedelta(minutes=20), dt.timedelta(minutes=20, microseconds=-1),
                             dt.timedelta(minutes=rng.random() * 60), dt.timedelta(0)])
            points.append((source, t))
    df = spark.createDataFrame(points, "type string, commit_time timestamp")
    gaps, sessions = brute([(s, t.replace(tzinfo=None)) for s, t in points], 20)
    ntz = lambda c: F.col(c).cast("timestamp_ntz")
    got = health.stall_gaps(df).select("source", ntz("from"), ntz("to"))
    assert sorted(tuple(r) for r in got.collect()) == gaps
    got = health.stall_sessions(df).select("source", ntz("start"), ntz("end"), "n")
    assert sorted(tuple(r) for r in got.collect()) == sessions


def test_dates(spark):
    df = spark.createDataFrame([("2025-01-31",), ("2025-02-31",), ("2025-1-31",), (None,)], "d string")
    assert [tuple(r) for r in df.select(times.valid_date(F.col("d")),
                                        times.valid_date(F.col("d"), real=True)).collect()] == [
        (True, True), (True, False), (False, False), (False, False)]


HEADER = "ver:3.0 server:s eventname:PROCESS_STATE_EXITED len:40"
EVENTS = [
    (HEADER, "processname:s groupname:g from_state:RUNNING", ("s", "RUNNING", "EXITED")),
    (HEADER, "groupname:g", ("unknown", "unknown", "EXITED")),
    ("PROCESS_STATE_FATAL len:5", "processname:x,from_state:STARTING", ("x", "STARTING", "FATAL")),
    ("eventname:TICK_60 len:10", "when:1", None),
    ("eventname:PROCESS_STATE_EXITED len:0", "", None),
    ("eventname:PROCESS_STATE_EXITED", "x", None),
    ("eventname:PROCESS_STATE_EXITED len:1048577", "x", None),
    ("eventname:PROCESS_STATE_EXITED len:1048576", "x", ("unknown", "unknown", "EXITED")),
    ("eventname:PROCESS_STATE_EXITED len:99999999999999999999999", "x", None),
]


def test_process_states(spark):
    df = spark.createDataFrame([(h, p) for h, p, _ in EVENTS], "header string, payload string")
    assert rows(health.process_states(df)) == sorted(w for _, _, w in EVENTS if w)


def test_latest_file(spark, folder):
    import os
    for i, name in enumerate(("a.json", "b.json", "c.json")):
        with open(f"{folder}/{name}", "w") as f:
            f.write("x" * (i + 1))
        os.utime(f"{folder}/{name}", (1000 + i % 2, 1000 + i % 2))
    found = files.file_inventory(spark, folder)
    assert sorted(r.length for r in found.collect()) == [1, 2, 3]
    assert files.latest_file(found).first().path.endswith("b.json")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
