"""Expensive columns that are filtered on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, also when it is filtered on.

    A filter on a projected column is pushed below the projection with the
    expression copied into it, once per mention.  The output of a generator is
    not, so JSON or URL parsing behind it runs a single time.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
