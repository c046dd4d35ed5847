import datetime as dt
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog import batches
from tidelog.operators import health
from tidelog.streaming import ingest, late, partials, state

T0 = dt.datetime(2025, 3, 1, tzinfo=dt.UTC)


def events(spark, data):
    """``(source, minutes)`` as events; a time may be missing."""
    return spark.createDataFrame([(s, None if m is None else float(m)) for s, m in data], "type string, m double").selectExpr(
        "type", "timestamp'2025-03-01 00:00:00' + make_dt_interval(0, 0, 0, m * 60) AS commit_time")


def plain(df):
    return rows(df.select("source", "start", "end", "n"))


def test_sessions_of_batches_are_those_of_the_whole(spark, folder):
    rnd = random.Random(1)
    data = [(s, rnd.uniform(0, 3000) if s != "busy" else rnd.uniform(0, 300)) for s in "abc" for _ in range(60)]
    data += [("busy", rnd.uniform(0, 400)) for _ in range(500)] + [(None, 5), (None, 6), ("a", None)]
    rnd.shuffle(data)
    write = late.session_writer(folder, delay=dt.timedelta(days=10))
    for n in range(5):
        write(events(spark, data[n::5]), n)
        whole = health.stall_sessions(events(spark, [d for i, d in enumerate(data) if i % 5 <= n]))
        assert plain(late.sessions(spark, folder)) == plain(whole)
    assert late.sessions(spark, folder).where("open").count() > 3


def test_sessions_close_behind_the_watermark_and_late_events_are_kept(spark, folder):
    write = late.session_writer(folder, delay=dt.timedelta(minutes=30))
    write(events(spark, [("a", 0), ("a", 10), ("b", 100)]), 0)
    write(events(spark, [("a", 69), ("a", 60), ("a", 75), ("b", 130)]), 1)
    got = {(r.source, r.n, r.open) for r in late.sessions(spark, folder).collect()}
    # 60 and 69 are behind 100 - 30, 75 is not; a's first session ended 20 minutes and more before the mark.
    assert got == {("a", 2, False), ("a", 1, False), ("b", 1, True)}
    lost = batches.read(late.late_events_table(spark, folder))
    assert lost.agg(F.sum("n")).first()[0] == 2
    # A silence of exactly twenty minutes separates; one microsecond less does not.
    write(events(spark, [("b", 150), ("b", 169.9999999), ("a", 94.99)]), 2)
    assert [r.n for r in late.sessions(spark, folder).where("source = 'b'").orderBy("start").collect()] == [1, 1, 2]
    assert batches.read(late.late_events_table(spark, folder)).agg(F.sum("n")).first()[0] == 3


def test_a_repeated_or_broken_batch_changes_nothing(spark, folder, monkeypatch):
    write = late.session_writer(folder, delay=dt.timedelta(minutes=30))
    first, second = events(spark, [("a", 0), ("a", 5)]), events(spark, [("a", 24), ("b", 500), ("b", 501)])
    write(first, 0)
    before = rows(late.sessions(spark, folder))
    with monkeypatch.context() as m:
        m.setattr(late, "note_seen", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(second, 1)
    assert rows(late.sessions(spark, folder)) == before
    for _ in range(2):
        write(second, 1)
    got = {(r.source, r.n, r.open) for r in late.sessions(spark, folder).collect()}
    assert got == {("a", 3, False), ("b", 2, True)}
    late.gather_sessions(spark, folder)
    write(second, 1)
    assert {(r.source, r.n, r.open) for r in late.sessions(spark, folder).collect()} == got


def arrivals(spark, *data):
    """``(id, what, minutes)``."""
    return spark.createDataFrame([(i, w, None if m is None else float(m)) for i, w, m in data], "id long, what string, m double").selectExpr(
        "id", "what", "timestamp'2025-03-01 00:00:00' + make_dt_interval(0, 0, 0, m * 60) AS collected_at")


def test_replays_once_and_late_rows_aside(spark, folder):
    write = late.once_writer(folder, ("id", "what"), dt.timedelta(minutes=60))
    write(arrivals(spark, *[(1, "a", 5)] * 500, (1, "a", 3), (2, "b", 4), (3, None, 4), (3, "null", 4)), 0)
    second = arrivals(spark, (1, "a", 50), (1, "b", 50), (3, None, 60), (4, "d", 2000), (5, "e", None))
    for _ in range(2):
        write(second, 1)
    write(arrivals(spark, (6, "f", 10), (1, "a", 6), (4, "d", 1990), (7, "g", 1940)), 2)
    good, behind, keys, _ = late.once_tables(spark, folder, second)
    kept = [(r.id, r.what) for r in batches.read(good).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a"), (2, "b"), (3, None), (3, "null"), (1, "b"), (4, "d"), (7, "g")], key=str)
    first = batches.read(good).where("id = 1 and what = 'a'").select(F.unix_seconds("collected_at")).first()[0]
    assert first == int(T0.timestamp()) + 180
    assert rows(batches.read(behind).select("id", "what")) == [(1, "a"), (5, "e"), (6, "f")]
    # Only keys of the delay's days are looked at.
    assert not any("day=2025-03-01" in f for f in batches.read(keys, upto=2, since="2025-03-02").inputFiles())


def test_an_interrupted_batch_does_not_take_its_own_rows_for_replays(spark, folder, monkeypatch):
    write = late.once_writer(folder, ("id",), dt.timedelta(minutes=60))
    batch = arrivals(spark, (1, "a", 5), (2, "b", 6))
    with monkeypatch.context() as m:
        m.setattr(late, "note_seen", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(batch, 0)
    write(batch, 0)
    assert batches.read(late.once_tables(spark, folder, batch)[0]).count() == 2


def test_counts_of_any_action_and_repeated_batches(spark, folder):
    table = partials.counts_table(spark, f"{folder}/counts")
    write = partials.partial_writer(table, partials.count_batch)

    def ops(*data):
        return spark.createDataFrame([(t, a, float(h)) for t, a, h in data], "type string, action string, h double").selectExpr(
            "type", "action", "timestamp'2025-03-01 00:00:00' + make_dt_interval(0, 0, 0, h * 3600) AS collected_at")
    first = ops(("a", "create", 1), ("a", "purge", 2), (None, "day", 3), ("a", None, 4), ("type", "type", 30))
    for _ in range(3):
        write(first, 0)
    write(ops(("a", "purge", 5), ("a", "create", 30)), 1)
    d1, d2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    want = [(d1, None, "day", 1), (d1, "a", "create", 1), (d1, "a", "purge", 2), (d2, "a", "create", 1), (d2, "type", "type", 1)]
    assert rows(batches.read(table)) == rows(spark.createDataFrame(want, "day date, type string, action string, n long"))
    batches.compact(table)
    write(ops(("a", "purge", 6)), 1)  # gathered already
    assert rows(batches.read(table)) == rows(spark.createDataFrame(want, "day date, type string, action string, n long"))


def test_sketches_merge_without_counting_twice(spark, folder):
    table = partials.health_table(spark, f"{folder}/health")
    write = partials.partial_writer(table, lambda r: partials.health_batch(r, "ts", "who", "kind"))

    def seen(low, high, minute):
        return spark.range(low, high).selectExpr("id AS who", "'k' AS kind", f"timestamp'2025-03-01 00:{minute}:00' AS ts")
    write(seen(0, 200, "01"), 0)
    write(seen(100, 300, "01").unionByName(seen(0, 300, "59")), 1)
    write(seen(0, 0, "01"), 2)
    for _ in range(2):
        minutes = {r.window_start.minute: r for r in partials.health_windows(table, "1 minute").collect()}
        hour = partials.health_windows(table, "1 hour").first()
        assert (minutes[1].active, minutes[59].active, hour.active) == (pytest.approx(300, rel=0.02),) * 3
        assert (minutes[1].n, hour.n, hour.lag_s, hour.key) == (400, 700, None, "k")
        batches.compact(table)


def test_progress_reports_are_stored(spark, folder):
    log = late.ProgressLog(spark, f"{folder}/log")
    spark.streams.addListener(log)
    try:
        for minutes in ((0, 1), (5000,), (2,)):
            arrivals(spark, *[(i, "x", m) for i, m in enumerate(minutes)]).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema("id long, what string, collected_at timestamp").parquet(f"{folder}/in")
            ingest.append_stream(state.replay_dedup_stream(stream, "10 minutes", keys=("id", "what")),
                                 f"{folder}/out", f"{folder}/cp").awaitTermination()
        deadline = time.time() + 30
        while time.time() < deadline:
            stored = late.ProgressLog.read(spark, f"{folder}/log").collect() if batches.child_names(spark, f"{folder}/log") else []
            if sum(r.late_rows for r in stored) == 1 and sum(r.input_rows for r in stored) == 4:
                break
            time.sleep(0.5)
        assert sum(r.late_rows for r in stored) == 1 and sum(r.input_rows for r in stored) == 4
    finally:
        spark.streams.removeListener(log)
