"""Partial results per micro-batch that merge: counts, lags, sketches.

A batch is reduced to partial results first, so a busy key shuffles one row per
task; the partial results of all batches are a table of batches and are merged on reading and by
compaction.  The answer is there at any time, also for a day or window that goes on, and a batch
that is repeated overwrites its own part.  No state, no watermark: nothing is late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.batches import BatchTable, first_batch, read, write_batch
from tidelog.functions import times
from tidelog.operators.counts import usable_events

#: Two to this power registers a sketch: 1.6 percent standard error, exact for small counts.
SKETCH_BITS = 12


def ingest_partials(rows: DataFrame, table: BatchTable, partial: Callable[[DataFrame], DataFrame], checkpoint: str,
                    every: str | None = None) -> StreamingQuery:
    """Start a stream that adds ``partial`` of each micro-batch to a table."""
    write = partial_writer(table, partial, first_batch(table, checkpoint))
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def partial_writer(table: BatchTable, partial: Callable[[DataFrame], DataFrame],
                   first: int = 0) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of :func:`ingest_partials`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(table, partial(batch), first + batch_id)

    return write


# ---- counts of any action ------------------------------------------------

def counts_table(spark: SparkSession, path: str) -> BatchTable:
    """``(day, type, action, n)``, by UTC day of collection."""
    return BatchTable(spark, path, "day date, type string, action string, n bigint", by="day", reduce=_sum_counts, flat=True)


def _sum_counts(partial: DataFrame) -> DataFrame:
    return partial.groupBy("day", "type", "action").agg(F.sum("n").alias("n"))


def count_batch(events: DataFrame) -> DataFrame:
    """Partial counts; whatever actions there are, a null type is a group of its own."""
    return usable_events(events).groupBy(F.to_date("collected_at").alias("day"), "type", "action").agg(
        F.count("*").alias("n"))


# ---- lag and activity per window -----------------------------------------

def health_table(spark: SparkSession, path: str) -> BatchTable:
    """``(day, window_start, key, lag_s, n, sketch)``: per window and key the largest lag, the
    number of rows, and a sketch of who was seen."""
    return BatchTable(spark, path, "day date, window_start timestamp, key string, lag_s bigint, n bigint, sketch binary",
                      by="day", reduce=_merge_health, flat=True)


def _merge_health(partial: DataFrame) -> DataFrame:
    return partial.groupBy("day", "window_start", "key").agg(
        F.max("lag_s").alias("lag_s"), F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def health_batch(rows: DataFrame, ts: str, who: str, key: str | None = None, seen: str | None = None,
                 width: str = "1 minute") -> DataFrame:
    """Partial lag and activity per window of ``ts``.

    ``who`` is counted; ``seen``, if rows have it, is when a row was collected, and lag is
    how far that is behind ``ts``.  Rows without ``ts`` have no window and are left out.
    """
    lag = times.epoch_seconds(F.col(seen)) - times.epoch_seconds(F.col(ts)) if seen else F.lit(None).cast("bigint")
    group = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    at = F.window(seen or ts, width)["start"]
    return (rows.where(F.col(ts).isNotNull()).groupBy(at.alias("window_start"), group.alias("key"))
            .agg(F.max(lag).alias("lag_s"), F.count("*").alias("n"),
                 F.hll_sketch_agg(F.col(who).cast("string"), SKETCH_BITS).alias("sketch"))
            .select(F.to_date("window_start").alias("day"), "window_start", "key", "lag_s", "n", "sketch"))


def health_windows(table: BatchTable, width: str, days: list[str] | None = None) -> DataFrame:
    """``(window_start, key, lag_s, n, active)`` of windows as long as the stored ones or longer.

    ``active`` is about how many were seen; sketches of short windows merge without counting anybody twice.
    """
    return (read(table, days).groupBy(F.window("window_start", width)["start"].alias("window_start"), "key")
            .agg(F.max("lag_s").alias("lag_s"), F.sum("n").alias("n"),
                 F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active")))
