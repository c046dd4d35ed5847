"""Label-service endpoints: clean, order, group, watch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import endpoints as E
from tidelog.functions.once import with_once
from tidelog.operators.ranking import with_position

# Fixed value: endpoints are served in groups of this many.
BATCH_SIZE = 10


def clean_endpoints(rows: DataFrame, *keep: str, column: str = "service_endpoint") -> DataFrame:
    """``(keep..., endpoint)``: normalized, valid ones; still one row per input row."""
    normal = with_once(rows.select(*keep, column), "endpoint", E.normalize_endpoint(F.col(column)))
    return normal.select(*keep, "endpoint").where(E.valid_endpoint(F.col("endpoint")))


def sorted_endpoints(clean: DataFrame) -> DataFrame:
    """Each endpoint once, in code-point order."""
    return clean.select("endpoint").distinct().orderBy("endpoint")


def duplicate_endpoints(clean: DataFrame) -> DataFrame:
    """``(endpoint, n)`` for endpoints listed more than once."""
    return clean.groupBy("endpoint").agg(F.count("*").alias("n")).where("n > 1")


def batch_assign(clean: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """``(endpoint, batch)``: consecutive groups of ``size`` in sorted order."""
    placed = with_position(clean.select("endpoint").distinct(), "endpoint")
    return placed.select("endpoint", F.floor(F.col("position") / size).alias("batch"))


def keep_label_frames(frames: DataFrame) -> DataFrame:
    return frames.where(F.col("kind") == "labels")


def resume_seq_by_endpoint(endpoints: DataFrame, labels: DataFrame) -> DataFrame:
    """``(endpoint, seq)``: last sequence number per endpoint, 0 when none."""
    last = labels.groupBy("endpoint").agg(F.max("seq").alias("seq"))
    return endpoints.select("endpoint").distinct().join(last, "endpoint", "left").select(
        "endpoint", F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"))


def active_endpoints(labels: DataFrame, batches: DataFrame, width: str = "1 second") -> DataFrame:
    """``(batch, window_start, n)``: endpoints of a batch with an update per window.

    Updates are first reduced to one row per endpoint and window, so the join
    with the batches does not see a busy endpoint's rows.
    """
    seen = labels.select(F.window("ts", width)["start"].alias("window_start"), "endpoint").distinct()
    return (seen.join(batches, "endpoint").groupBy("batch", "window_start")
            .agg(F.count("*").alias("n")))
