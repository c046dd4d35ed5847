"""Identity-operation exports: cursors, increments, pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resume_created_at(operations: DataFrame, column: str = "createdAt") -> DataFrame:
    """``(created_at)``: newest operation time, empty text when there is none."""
    newest = F.max(F.col(column)).cast("string")
    return operations.agg(F.coalesce(newest, F.lit("")).alias("created_at"))


def newer_than(operations: DataFrame, cursor, column: str = "createdAt") -> DataFrame:
    """Operations past the cursor (a value or a column); no cursor keeps all."""
    if cursor is None or (isinstance(cursor, str) and cursor == ""):
        return operations
    return operations.where(F.col(column) > cursor)


def append_pages(operations: DataFrame, page: DataFrame) -> DataFrame:
    """All lines of both; a page fetched twice is kept twice."""
    return operations.unionByName(page)


def distinct_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each line once.  Copies collapse before the shuffle."""
    return lines.select(column).distinct()


def caught_up(operations: DataFrame, as_of: dt.datetime | str, limit: str = "1 minute",
              column: str = "created_at") -> DataFrame:
    """``(caught_up)``: is the newest operation at most ``limit`` before ``as_of``?

    No operation at all means there is nothing left to fetch.
    """
    age = F.lit(as_of).cast("timestamp") - F.max(column)
    near = age <= F.expr(f"interval '{limit.split()[0]}' {limit.split()[1]}")
    return operations.agg(F.coalesce(near, F.lit(True)).alias("caught_up"))
