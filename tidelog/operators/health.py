"""Cursors, lag and stalls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import messages, times
from tidelog.functions.once import with_once
from tidelog.sources.days import latest_day


def resume_seq(events: DataFrame) -> DataFrame:
    """``(seq)``: last sequence number of the newest day.

    Only that day is read if ``events`` come from :func:`tidelog.sources.days.newest_day`;
    of any other table the days are looked through for the newest.
    """
    return latest_day(events).agg(F.max("seq").alias("seq"))


def last_valid_event(events: DataFrame, *columns: str) -> DataFrame:
    """The event with the largest sequence number of the newest day.

    Ties go to the larger remaining columns, so the answer does not depend on
    the order of arrival.
    """
    rest = [c for c in (columns or events.columns) if c != "seq"]
    newest = F.max(F.struct("seq", *rest))
    return latest_day(events).agg(newest.alias("e")).where("e is not null").select("e.*")


def lag_status(row: DataFrame, limit_h: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(keep..., lag_s, lag_h, status)`` of ``collected_at`` against ``commit_time``.

    Whole seconds, whole hours cut towards zero; ``alert`` above ``limit_h``
    hours, ``error`` when a time is missing.
    """
    lag = row.select(*keep, (times.epoch_seconds(F.col("collected_at"))
                      - times.epoch_seconds(F.col("commit_time"))).alias("lag_s"))
    lag = lag.withColumn("lag_h", F.expr("lag_s div 3600"))
    return lag.withColumn("status", F.when(F.col("lag_s").isNull(), "error")
                          .when(F.col("lag_h") > limit_h, "alert").otherwise("ok"))


def lag_monitor(events: DataFrame, limit_h: int = 1) -> DataFrame:
    return lag_status(last_valid_event(events, "seq", "collected_at", "commit_time"), limit_h)


def _buckets(events: DataFrame, ts: str, source: str, minutes: int) -> DataFrame:
    """First, last and number of events per source and ``minutes`` of time.

    Two events of one bucket are less than ``minutes`` apart, so every longer
    silence lies between two buckets.  This reduces a busy source before the
    shuffle to one row per bucket; no task ever sorts its events.
    """
    width = minutes * 60_000_000
    bucket = F.floor(F.unix_micros(ts) / F.lit(width)).cast("bigint")
    return events.where(F.col(ts).isNotNull()).groupBy(
        F.col(source).alias("source"), bucket.alias("bucket")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"))


def stall_gaps(events: DataFrame, minutes: int = 20, ts: str = "commit_time",
               source: str = "type", as_of: Column | None = None) -> DataFrame:
    """``(source, from, to)``: silences of at least ``minutes``.

    With ``as_of``, a source that has been silent for so long by then has a
    silence without an end.
    """
    per = Window.partitionBy("source").orderBy("bucket")
    limit = minutes * 60_000_000
    buckets = _buckets(events, ts, source, minutes)
    before, after = F.lag("last").over(per), F.lead("first").over(per)
    if as_of is None:
        gaps = buckets.select("source", before.alias("from"), F.col("first").alias("to"))
        return gaps.where(F.unix_micros("to") - F.unix_micros("from") >= limit)
    # Each bucket looks ahead, the last one of a source to the present.
    gaps = buckets.select("source", F.col("last").alias("from"), after.alias("to"))
    return gaps.where(F.unix_micros(F.coalesce("to", as_of)) - F.unix_micros("from") >= limit)


#: Blocks that are compared with one another in one task, and how often blocks join to larger ones.
FAN, LEVELS = 1 << 14, 4


def sequence_gaps(events: DataFrame, width: int = 100_000, seq: str = "seq") -> DataFrame:
    """``(first_missing, last_missing)``: ranges of sequence numbers that never arrived.

    Numbers are compared inside blocks of ``width``; of a block only its ends go
    on, and are compared inside blocks of ``FAN`` blocks, and so on: no window
    takes more than ``FAN`` rows.  What is left after ``LEVELS`` rounds are the few largest
    blocks that 64 bits have room for, compared as one list.
    """
    block = F.floor(F.col(seq) / F.lit(width)).cast("bigint").alias("block")
    once = events.where(F.col(seq).isNotNull()).select(F.col(seq).alias("first"), F.col(seq).alias("last"), block).distinct()
    gaps = []
    for _ in range(LEVELS):
        before = F.lag("last").over(Window.partitionBy("block").orderBy("first"))
        gaps.append(once.select("first", before.alias("before")))
        once = once.groupBy("block").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
            "first", "last", F.floor(F.col("block") / F.lit(FAN)).cast("bigint").alias("block"))
    ends = once.agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("e"))
    pairs = F.transform(F.col("e"), lambda x, i: F.struct(x["first"].alias("first"), F.get("e", i - 1)["last"].alias("before")))
    gaps.append(ends.select(F.inline(pairs)))
    found = gaps[0]
    for more in gaps[1:]:
        found = found.unionByName(more)
    return found.where("first - before > 1").select(
        (F.col("before") + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing"))


def stall_sessions(events: DataFrame, minutes: int = 20, ts: str = "commit_time",
                   source: str = "type") -> DataFrame:
    """``(source, start, end, n)``: live periods between the silences."""
    pieces = _buckets(events, ts, source, minutes).select(
        "source", F.col("first").alias("start"), F.col("last").alias("end"), "n")
    return merge_sessions(pieces, minutes)


def merge_sessions(pieces: DataFrame, minutes: int = 20) -> DataFrame:
    """``(source, start, end, n)``: pieces of live periods joined where no silence lies between.

    Pieces may overlap and come from anywhere, so sessions found in parts of
    the events, one after the other or again, merge to those of the whole.
    """
    per = Window.partitionBy("source").orderBy("start", "end")
    before = F.max("end").over(per.rowsBetween(Window.unboundedPreceding, -1))
    quiet = F.unix_micros("start") - F.unix_micros(before) >= minutes * 60_000_000
    marked = pieces.withColumn("_starts", F.coalesce(quiet, F.lit(True)).cast("int"))
    numbered = marked.withColumn("_session", F.sum("_starts").over(per.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("source", "_session").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.sum("n").alias("n")).drop("_session")


def _state_lines(lines: DataFrame, max_len: int) -> DataFrame:
    """State-change lines with ``reject_reason``, null where the payload length is within bounds."""
    header = F.col("header")
    # The substring test drops most other events before any pattern is tried.
    named = lines.where(header.contains(messages.STATE_PREFIX)
                        & messages.event_name(header).startswith(messages.STATE_PREFIX))
    sized = with_once(named, "_len", messages.payload_length(header))
    reason = (F.when(F.col("_len").isNull(), "no length").when(F.col("_len") < 1, "empty payload")
              .when(F.col("_len") > max_len, "payload too long"))
    return sized.withColumn("reject_reason", reason).drop("_len")


def process_state_filter(lines: DataFrame, max_len: int = messages.MAX_PAYLOAD) -> DataFrame:
    """State-change lines whose payload length is within bounds."""
    return _state_lines(lines, max_len).where("reject_reason is null").drop("reject_reason")


def process_state_rejects(lines: DataFrame, max_len: int = messages.MAX_PAYLOAD) -> DataFrame:
    """The state-change lines that the filter refuses, with ``reject_reason``."""
    return _state_lines(lines, max_len).where("reject_reason is not null")


def process_states(lines: DataFrame, max_len: int = messages.MAX_PAYLOAD) -> DataFrame:
    """``(process, from_state, to_state)`` of usable process-state lines."""
    header, payload = F.col("header"), F.col("payload")
    return process_state_filter(lines, max_len).select(
        messages.process_name(payload).alias("process"),
        messages.from_state(payload).alias("from_state"),
        messages.to_state(header).alias("to_state"))
