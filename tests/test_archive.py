import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.operators import archive, sinks
from tidelog.plans import daily

DAY = dt.date(2025, 10, 22)


def land(spark, path, n=500):
    df = spark.range(n).selectExpr(
        "date_add(date'2025-10-21', cast(id % 3 as int)) AS collect_date",
        """'{"type":"t' || id % 5 || '","action":"' || if(id % 2 = 0, 'create', 'delete') || '","seq":' || id || '}' AS value""")
    sinks.day_ndjson_sink(df, path)


def roots(folder, *names):
    for n in names:
        os.makedirs(f"{folder}/{n}")
    return [f"{folder}/{n}" for n in names]


def test_daily_job_and_its_repetition(spark, folder):
    land(spark, f"{folder}/raw")
    copies = roots(folder, "a", "b")
    as_of = DAY + dt.timedelta(days=1)
    dry = daily.run_day(spark, f"{folder}/raw", f"{folder}/z", copies, as_of, dry_run=True)
    assert dry.count() == 5 and not os.path.exists(f"{folder}/z")
    for _ in range(2):
        report = daily.run_day(spark, f"{folder}/raw", f"{folder}/z", copies, as_of)
        assert {(r.root, r.ok, r.safe) for r in report.collect()} == {(c, True, True) for c in copies}
    stored = f"{folder}/a/month=2025-10/collect_date=2025-10-22"
    assert any(n.endswith(".gz") for n in os.listdir(stored + "/lines"))
    counts = spark.read.option("header", True).csv(stored + "/counts")
    assert counts.columns == ["type", "create", "delete", "update", "other"] and counts.count() == 5
    assert archive.gzip_day(spark, f"{folder}/raw", DAY, f"{folder}/z") is False


def test_late_lines_are_archived_by_the_next_run(spark, folder):
    copies, as_of = roots(folder, "a"), DAY + dt.timedelta(days=1)
    for n in (15, 21):
        land(spark, f"{folder}/raw", n)
        report = daily.run_day(spark, f"{folder}/raw", f"{folder}/z", copies, as_of)
        assert [(r.ok, r.safe) for r in report.collect()] == [(True, True)]
    raw = spark.read.text(archive.day_path(f"{folder}/raw", DAY)).count()
    assert raw == 12 == spark.read.text(archive.day_path(f"{folder}/z", DAY)).count()
    assert archive.read_copies(spark, DAY, copies).count() == 12


def test_an_archive_that_lacks_lines_is_not_safe(spark, folder):
    land(spark, f"{folder}/raw", 15)
    copies = roots(folder, "a")
    daily.run_day(spark, f"{folder}/raw", f"{folder}/z", copies, DAY + dt.timedelta(days=1))
    land(spark, f"{folder}/raw", 15)
    source = daily.day_lines(spark, f"{folder}/raw", f"{folder}/z", DAY).withColumn("day", F.lit(DAY))
    verified = archive.backup_verify(archive.fingerprint(source, "day"), archive.fingerprint(
        archive.read_copies(spark, DAY, copies), "root", "day"), copies)
    assert rows(archive.retention_gate(verified)) == [(DAY, False)]


def test_open_days_and_days_without_a_usable_line_are_refused(spark, folder):
    land(spark, f"{folder}/raw")
    with pytest.raises(daily.DayOpen):
        daily.run_day(spark, f"{folder}/raw", f"{folder}/z", [], DAY, date=DAY)
    spark.createDataFrame([("{bad",)], "value string").write.text(f"{folder}/bad/collect_date=2025-10-22")
    with pytest.raises(daily.NothingUsable):
        daily.run_day(spark, f"{folder}/bad", f"{folder}/z", [], DAY + dt.timedelta(days=1))


def test_compressed_day_is_enough(spark, folder):
    land(spark, f"{folder}/raw")
    archive.gzip_day(spark, f"{folder}/raw", DAY, f"{folder}/z")
    report = daily.run_day(spark, f"{folder}/elsewhere", f"{folder}/z", roots(folder, "a"),
                           DAY + dt.timedelta(days=1))
    assert [r.safe for r in report.collect()] == [True]


def test_missing_day(spark, folder):
    with pytest.raises(daily.DayMissing):
        daily.run_day(spark, f"{folder}/raw", f"{folder}/z", [], DAY)


def test_missing_root_closes_the_gate(spark, folder):
    land(spark, f"{folder}/raw")
    wanted = roots(folder, "a") + [f"{folder}/not-there"]
    report = daily.run_day(spark, f"{folder}/raw", f"{folder}/z", wanted, DAY + dt.timedelta(days=1))
    assert {(r.root.rsplit("/", 1)[1], r.ok, r.safe) for r in report.collect()} == {
        ("a", True, False), ("not-there", False, False)}


def lines(spark, *values):
    return spark.createDataFrame([(DAY, v) for v in values], "day date, value string")


@pytest.mark.parametrize("copy,ok", [
    (("a", "b", "b"), True), (("b", "a", "b"), True), (("a", "b", "x"), False), (("a", "b"), False),
    (("a", "a", "b"), False), (("a", "b", "b", "b"), False)])
def test_copies_are_compared_by_content(spark, copy, ok):
    theirs = archive.fingerprint(lines(spark, *copy).withColumn("root", F.lit("r")), "root", "day")
    got = archive.backup_verify(archive.fingerprint(lines(spark, "a", "b", "b"), "day"), theirs, ["r"])
    assert got.first().ok is ok


def test_no_copy_at_all(spark):
    none = archive.fingerprint(archive.read_copies(spark, DAY, ["/nowhere"]), "root", "day")
    got = archive.backup_verify(archive.fingerprint(lines(spark, "a"), "day"), none, ["r"])
    assert rows(archive.retention_gate(got)) == [(DAY, False)]


def test_day_folders_append(spark, folder):
    for _ in range(2):
        land(spark, f"{folder}/raw", 30)
    assert spark.read.text(f"{folder}/raw").count() == 60
    assert sorted(n for n in os.listdir(f"{folder}/raw") if "=" in n) == [
        f"collect_date=2025-10-{d}" for d in (21, 22, 23)]
