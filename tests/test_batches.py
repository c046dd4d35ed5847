import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog import batches as B

SCHEMA = "seq bigint, what string, day date"


def table(spark, folder, **kw):
    return B.BatchTable(spark, f"{folder}/t", **{"schema": SCHEMA, "by": "day", "seq": F.col("seq"), **kw})


def day(n):
    return dt.date(2025, 1, n)


def batch(spark, *data):
    return spark.createDataFrame([(s, f"w{s}", day(d)) for s, d in data], SCHEMA)


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_ledger_reads_and_resumes_without_a_scan(spark, folder):
    t = table(spark, folder)
    assert B.resume_seq(t).first().seq is None and B.read(t).count() == 0 and B.last_batch(t) == -1
    B.write_batch(t, batch(spark, (1, 1), (2, 1), (3, 2)), 0)
    B.write_batch(t, batch(spark), 1)
    B.write_batch(t, batch(spark, (9, 1), (5, 2)), 2)
    want = [(None, 0, "2025-01-01", 1, 2, 2), (None, 0, "2025-01-02", 3, 3, 1), (None, 2, "2025-01-01", 9, 9, 1),
            (None, 2, "2025-01-02", 5, 5, 1)]
    assert rows(B.ledger(t).select("set", "batch_id", "part", "least_seq", "greatest_seq", "rows")) == rows(
        spark.createDataFrame(want, "set long, batch_id long, part string, a long, b long, c long"))
    assert B.resume_seq(t).first().seq == 5 and B.last_part(t) == "2025-01-02" and B.last_batch(t) == 2
    # The data may be gone: the cursor does not look at them.
    B.delete(spark, t.folder(2))
    assert B.resume_seq(t).first().seq == 5


def test_half_a_batch_does_not_count_and_a_repeated_one_counts_once(spark, folder, monkeypatch):
    t = table(spark, folder)
    B.write_batch(t, batch(spark, (1, 1)), 0)
    with monkeypatch.context() as m:
        m.setattr(B, "_summary", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            B.write_batch(t, batch(spark, (2, 1), (3, 1)), 1)
    assert seqs(B.read(t)) == [1]
    for _ in range(2):
        B.write_batch(t, batch(spark, (2, 2), (3, 2)), 1)
    assert seqs(B.read(t)) == [1, 2, 3]


def test_a_day_is_read_without_the_batches_of_other_days(spark, folder):
    t = table(spark, folder)
    for n in range(6):
        B.write_batch(t, batch(spark, (n, 1 + n // 3)), n)
    got = B.read(t, ["2025-01-02"])
    assert seqs(got) == [3, 4, 5]
    assert {f.split("batch_id=")[1][0] for f in got.inputFiles()} == {"3", "4", "5"}
    B.compact(t, upto=3)
    got = B.read(t, ["2025-01-02"])
    assert seqs(got) == [3, 4, 5]
    assert not any("batch_id=3" in f or "day=2025-01-01" in f for f in got.inputFiles())


def test_readers_see_every_row_once_before_during_and_after(spark, folder, monkeypatch):
    t = table(spark, folder)
    for n in range(4):
        B.write_batch(t, batch(spark, (2 * n, 1), (2 * n + 1, 2 + n % 2)), n)
    before = B.read(t)
    # The compaction dies once its files are written, before the ledger has its state.
    real, seen = B._summary, []
    with monkeypatch.context() as m:
        m.setattr(B, "_summary", lambda *a: seen.append(seqs(B.read(t))) or 1 / 0)
        with pytest.raises(ZeroDivisionError):
            B.compact(t)
    assert seen == [list(range(8))] and os.path.isdir(f"{t.path}/_sets/set=0")
    assert seqs(B.read(t)) == list(range(8))
    assert B._summary is real and B.compact(t) == 0
    assert seqs(before) == seqs(B.read(t)) == list(range(8))
    assert not any("batch_id" in f for f in B.read(t).inputFiles())
    assert B.resume_seq(t).first().seq == 7 and B.last_batch(t) == 3
    assert B.compact(t) is None


def test_a_batch_repeated_after_it_was_gathered_changes_nothing(spark, folder):
    t = table(spark, folder)
    B.write_batch(t, batch(spark, (1, 1)), 0)
    B.compact(t)
    assert not B.write_batch(t, batch(spark, (1, 9)), 0)
    assert rows(B.read(t)) == rows(batch(spark, (1, 1)))


def test_gathered_sets_grow_with_the_new_rows_only(spark, folder):
    t = table(spark, folder)
    for n in range(3):
        B.write_batch(t, batch(spark, (n, 1), (10 + n, 2 + n)), n)
        B.compact(t)
    assert seqs(B.read(t)) == [0, 1, 2, 10, 11, 12]
    assert B.state(t).sets.__len__() == 6 and B.state(t).generation == 2
    assert sorted(os.listdir(f"{t.path}/_sets/set=1"))[-2:] == ["day=2025-01-01", "day=2025-01-03"]


def test_sweep_keeps_what_the_last_two_states_need(spark, folder):
    t = table(spark, folder)
    B.write_batch(t, batch(spark, (1, 1)), 0)
    B.compact(t)
    old = B.read(t)
    B.write_batch(t, batch(spark, (2, 1)), 1)
    between = B.read(t)
    assert B.sweep(t) == 0
    B.compact(t)
    assert B.sweep(t) == 2 and not os.path.isdir(t.folder(0)) and os.path.isdir(t.folder(1))
    assert seqs(old) == [1] and seqs(between) == seqs(B.read(t)) == [1, 2]


def summed(df):
    return df.groupBy("day", "what").agg(F.sum("n").alias("n")).select("day", "what", "n")


def counted(spark, *data):
    return spark.createDataFrame([(day(d), w, n) for d, w, n in data], "day date, what string, n bigint")


def test_reduced_tables_rewrite_only_the_parts_touched(spark, folder):
    t = B.BatchTable(spark, f"{folder}/t", "day date, what string, n bigint", by="day", reduce=summed, flat=True)
    B.write_batch(t, counted(spark, (1, "a", 2), (1, "b", 1), (2, "a", 5)), 0)
    B.write_batch(t, counted(spark, (1, "a", 3)), 1)
    want = counted(spark, (1, "a", 5), (1, "b", 1), (2, "a", 5))
    assert rows(B.read(t)) == rows(want)
    B.compact(t)
    assert rows(B.read(t)) == rows(want)
    B.write_batch(t, counted(spark, (2, "a", 1), (3, None, 4)), 2)
    B.write_batch(t, counted(spark), 3)
    B.compact(t)
    assert rows(B.read(t)) == rows(counted(spark, (1, "a", 5), (1, "b", 1), (2, "a", 6), (3, None, 4)))
    assert sorted(B.state(t).sets) == [(0, "2025-01-01"), (1, "2025-01-02"), (1, "2025-01-03")]
    assert rows(B.read(t, ["2025-01-02"])) == rows(counted(spark, (2, "a", 6)))
    B.write_batch(t, counted(spark, (2, "a", 1)), 4)
    B.compact(t)
    assert B.sweep(t) and sorted(c for c in os.listdir(f"{t.path}/_sets/set=0") if "=" in c) == ["day=2025-01-01"]
    assert rows(B.read(t)) == rows(counted(spark, (1, "a", 5), (1, "b", 1), (2, "a", 7), (3, None, 4)))


def test_parts_that_are_null_and_tables_without_parts(spark, folder):
    t = table(spark, folder)
    B.write_batch(t, spark.createDataFrame([(1, "w1", None), (2, "w2", day(1))], SCHEMA), 0)
    assert seqs(B.read(t)) == [1, 2]
    B.compact(t)
    assert rows(B.read(t)) == [(1, "w1", None), (2, "w2", day(1))]
    whole = B.BatchTable(spark, f"{folder}/whole", "value string", fmt="text")
    for n in range(2):
        B.write_batch(whole, spark.createDataFrame([(f"line {n}",)], "value string"), n)
        assert rows(B.read(whole)) == [(f"line {i}",) for i in range(n + 1)]
    B.compact(whole)
    assert rows(B.read(whole)) == [("line 0",), ("line 1",)]


def test_a_lost_checkpoint_goes_on_behind_the_table(spark, folder):
    t = table(spark, folder)
    assert B.first_batch(t, f"{folder}/cp0") == 0
    B.write_batch(t, batch(spark, (1, 1)), 0)
    B.write_batch(t, batch(spark, (2, 1)), 1)
    assert B.first_batch(t, f"{folder}/cp0") == 0 and B.first_batch(t, f"{folder}/cp1") == 2
    B.compact(t)
    assert B.first_batch(t, f"{folder}/cp2") == 2
