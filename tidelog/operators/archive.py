"""Compressed days, copies, verification."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import path_exists, write_complete


def day_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/collect_date={day.isoformat()}"


def copy_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/month={day:%Y-%m}/collect_date={day.isoformat()}"


def gzip_day(spark: SparkSession, path: str, day: dt.date, out: str) -> bool:
    """Write a day compressed; False when the same lines are there already.

    A gzip file cannot be split on reading, so the lines are spread over files of
    bounded size.  Only a write that finished counts as being there, and an
    archive that lacks lines the raw day has, or has others, is written anew.
    """
    target = day_path(out, day)
    lines = spark.read.text(day_path(path, day)).select("value")
    if write_complete(spark, target) and same_lines(lines, spark.read.text(target).select("value")):
        return False
    (lines.hint("rebalance").write.mode("overwrite").option("compression", "gzip").text(target))
    return True


def replicate_by_month(spark: SparkSession, archive: str, day: dt.date, roots: list[str],
                       counts: DataFrame | None = None) -> None:
    """Copy a compressed day, and its counts, below ``month=YYYY-MM`` of each root.

    A root that does not exist is left alone; verification then reports it.
    """
    lines = spark.read.text(day_path(archive, day)).select("value")
    for root in roots:
        if not path_exists(spark, root):
            continue
        target = copy_path(root, day)
        lines.write.mode("overwrite").option("compression", "gzip").text(target + "/lines")
        if counts is not None:
            counts.write.mode("overwrite").option("header", True).csv(target + "/counts")


def fingerprint(lines: DataFrame, *keys: str) -> DataFrame:
    """``(keys, n_rows, content_hash)``, whatever the order and file layout.

    The hashes are added, not xor-ed: equal lines would cancel out in pairs.
    """
    total = F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("decimal(38,0)")
    return lines.groupBy(*keys).agg(F.count("*").alias("n_rows"), total.alias("content_hash"))


def same_lines(a: DataFrame, b: DataFrame) -> bool:
    """Do both hold the same lines, as often, in any order?"""
    return fingerprint(a).first() == fingerprint(b).first()


def backup_verify(source: DataFrame, copies: DataFrame, roots: list[str]) -> DataFrame:
    """``(day, root, ok)``: is the copy in each root equal and not empty?

    Takes fingerprints: the source's by ``day``, the copies' by ``(root, day)``.
    A root without a copy is not ok.
    """
    wanted = source.select("day", "n_rows", "content_hash", F.explode(
        F.array(*[F.lit(r) for r in roots])).alias("root"))
    theirs = copies.select("day", "root", F.col("n_rows").alias("copy_rows"),
                           F.col("content_hash").alias("copy_hash"))
    same = (F.col("n_rows") > 0) & (F.col("n_rows") == F.col("copy_rows")) & (
        F.col("content_hash") == F.col("copy_hash"))
    return wanted.join(theirs, ["day", "root"], "left").select(
        "day", "root", F.coalesce(same, F.lit(False)).alias("ok"))


def retention_gate(verified: DataFrame) -> DataFrame:
    """``(day, safe)``: a day may go once every copy of it is verified."""
    return verified.groupBy("day").agg(F.bool_and("ok").alias("safe"))


def read_copies(spark: SparkSession, day: dt.date, roots: list[str]) -> DataFrame:
    """``(root, day, value)``: the lines of a day's copies, roots without one left out."""
    parts = [spark.read.text(copy_path(r, day) + "/lines").select(
        F.lit(r).alias("root"), F.lit(day).alias("day"), "value")
        for r in roots if write_complete(spark, copy_path(r, day) + "/lines")]
    if not parts:
        return spark.createDataFrame([], "root string, day date, value string")
    copies = parts[0]
    for p in parts[1:]:
        copies = copies.unionByName(p)
    return copies
