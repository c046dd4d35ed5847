"""Stateful streams: replays, sessions, lag, activity, running counts.

The watermark is on collection time, which a stream sees in order, and has to be
longer than the longest replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import times
from tidelog.operators.counts import usable_events


def replay_dedup_stream(events: DataFrame, delay: str, ts: str = "collected_at",
                        keys: tuple[str, ...] = ("seq", "uri", "action")) -> DataFrame:
    """One copy of events that arrive again within ``delay``."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def replay_dedup_frames(frames: DataFrame, delay: str, ts: str = "collected_at") -> DataFrame:
    """One copy of commit frames that arrive again within ``delay``.

    Whole frames, before their ops are exploded: the state holds a number and a
    digest of the content per commit, not a long text per op.
    """
    content = F.md5(F.to_json(F.struct(*[c for c in frames.columns if c != ts])))
    once = frames.withColumn("_content", content).withWatermark(ts, delay)
    return once.dropDuplicatesWithinWatermark(["seq", "_content"]).drop("_content")


def stall_sessions_stream(events: DataFrame, minutes: int = 20, delay: str = "1 hour",
                          ts: str = "commit_time", source: str = "type") -> DataFrame:
    """``(source, start, end, n)``: live periods, each given out once it is over.

    Spark joins sessions that touch, so the gap is one microsecond short of the
    limit: a silence of exactly ``minutes`` separates.
    """
    gap = f"{minutes * 60 - 1} seconds 999999 microseconds"
    return (events.withWatermark(ts, delay)
            .groupBy(F.col(source).alias("source"), F.session_window(ts, gap).alias("w"))
            .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"))
            .select("source", "start", "end", "n"))


def lag_windows(events: DataFrame, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """``(window_start, lag_s)``: largest lag per tumbling window of collection time."""
    lag = times.epoch_seconds(F.col("collected_at")) - times.epoch_seconds(F.col("commit_time"))
    return (events.withWatermark("collected_at", delay)
            .groupBy(F.window("collected_at", width).alias("w"))
            .agg(F.max(lag).alias("lag_s"))
            .select(F.col("w.start").alias("window_start"), "lag_s"))


def active_endpoint_windows(labels: DataFrame, width: str = "1 second",
                            delay: str = "1 minute") -> DataFrame:
    """``(window_start, n)``: about how many endpoints updated per window."""
    return (labels.withWatermark("ts", delay)
            .groupBy(F.window("ts", width).alias("w"))
            .agg(F.approx_count_distinct("endpoint").alias("n"))
            .select(F.col("w.start").alias("window_start"), "n"))


def day_counts(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``(day, type, action, n)`` per UTC day, given out when the day is over.

    Long form, so that no action is left out; ``partials.counts_table`` has the counts of
    days that are not over.
    """
    return (usable_events(events).withWatermark("collected_at", delay)
            .groupBy(F.window("collected_at", "1 day").alias("w"), "type", "action")
            .agg(F.count("*").alias("n"))
            .select(F.to_date("w.start").alias("day"), "type", "action", "n"))
