"""The daily job: count, compress, copy, verify, decide."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import archive, counts
from tidelog.session import stage
from tidelog.sources import days, lines


class DayMissing(Exception):
    """Neither raw nor compressed data exists for the day."""


class DayOpen(Exception):
    """The day is not over, so lines may still arrive."""


class NothingUsable(Exception):
    """The day has lines, but none that can be counted."""


def day_lines(spark: SparkSession, raw: str, archived: str, day: dt.date) -> DataFrame:
    """Lines of a day: the raw ones while they exist, else the compressed ones."""
    if archive.path_exists(spark, archive.day_path(raw, day)):
        return spark.read.text(archive.day_path(raw, day)).select("value")
    if archive.write_complete(spark, archive.day_path(archived, day)):
        return spark.read.text(archive.day_path(archived, day)).select("value")
    raise DayMissing(f"no data for {day}")


def count_day(day: DataFrame) -> DataFrame:
    """Counts of the usable lines of a day, actions that are not listed under ``other``."""
    parsed = lines.parse_lines(day, schemas.COUNTED, required=("type",), not_null=("action",))
    return counts.type_action_counts(counts.counts_long(lines.accepted(parsed)), counts.ACTIONS)


def run_day(spark: SparkSession, raw: str, archived: str, roots: list[str], as_of: dt.date,
            date: dt.date | None = None, dry_run: bool = False) -> DataFrame:
    """Work off one day; ``(day, root, ok, safe)`` says what can be removed.

    Can be repeated: as long as the raw day is there it is the truth, and lines
    that came late are archived, copied and verified by the next run.  Only when
    it is gone does the archive take its place.  A dry run only reads and counts.
    """
    day = days.target_day(as_of, date)
    if day >= as_of:
        raise DayOpen(f"{day} is not over on {as_of}")
    found = day_lines(spark, raw, archived, day)
    table = stage(count_day(found), "day-counts")
    if not table.limit(1).count() and found.limit(1).count():
        raise NothingUsable(f"no line of {day} can be counted")
    if dry_run:
        return table
    if archive.path_exists(spark, archive.day_path(raw, day)):
        archive.gzip_day(spark, raw, day, archived)
    archive.replicate_by_month(spark, archived, day, roots, counts=table)
    source = day_lines(spark, raw, archived, day).withColumn("day", F.lit(day))
    verified = archive.backup_verify(
        archive.fingerprint(source, "day"),
        archive.fingerprint(archive.read_copies(spark, day, roots), "root", "day"), roots)
    return verified.join(archive.retention_gate(verified), "day")
