"""Selecting and checking UTC days."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import child_names


def target_day(as_of: dt.date, date: dt.date | None = None) -> dt.date:
    """The requested day, by default the one before ``as_of``."""
    return date or as_of - dt.timedelta(days=1)


def day_partition(events: DataFrame, as_of: dt.date, date: dt.date | None = None,
                  column: str = "collect_date") -> DataFrame:
    """Events of one day; on a partitioned table only that partition is read."""
    return events.where(F.col(column) == F.lit(target_day(as_of, date)))


def newest_day(spark: SparkSession, path: str, schema: str, column: str = "collect_date",
               fmt: str = "parquet") -> DataFrame:
    """Events of the newest day folder below ``path``, and of no other.

    The day comes from the folders' names: one listing of a level that has a
    folder per day, no file opened.  Folders that hold nothing yet, or whose
    name is no day, are passed over.
    """
    days = sorted((d for d in child_names(spark, path) if re.fullmatch(rf"{column}=\d{{4}}-\d\d-\d\d", d)), reverse=True)
    reader = spark.read.schema(schema)
    for day in days:
        if any(not f.startswith(("_", ".")) for f in child_names(spark, f"{path}/{day}")):
            only = reader.format(fmt).option("basePath", path).load(f"{path}/{day}")
            return only.where(F.col(column) == F.lit(dt.date.fromisoformat(day.split("=")[1])))
    return spark.createDataFrame([], schema)


def latest_day(events: DataFrame, column: str = "collect_date") -> DataFrame:
    """Events of the newest day that has any, of a table without day folders.

    The day comes from a scalar subquery over the whole column; a table by day
    is read with :func:`newest_day`, which looks at folder names only.
    """
    newest = events.select(F.max(column)).scalar()
    return events.where(F.col(column) == newest)


def missing_days(events: DataFrame, first: Column, last: Column,
                 column: str = "collect_date") -> DataFrame:
    """``(missing_date)``: days of ``first..last`` without a single event."""
    spark = events.sparkSession
    expected = spark.range(1).select(
        F.explode(F.sequence(first, last)).alias("missing_date"))
    present = events.select(F.col(column).alias("missing_date")).distinct()
    return expected.join(present, "missing_date", "left_anti")
