"""Registration of catalog queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its DuckDB twin where SQL has one."""
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return run
    return register


def text_time(ts: str | Column) -> Column:
    """Times leave the catalog as text, which both engines print alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def text_day(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


# The DuckDB side of text_time.
SQL_TIME = "%Y-%m-%d %H:%M:%S.%f"
