"""What comes late: a watermark kept as data, and side outputs for the rows behind it.

Spark drops rows behind its watermark and tells their number in progress reports.  Here
every micro-batch notes the greatest time seen so far, so the next one knows its
watermark, and rows behind it go to a table of their own.  :class:`ProgressLog` stores the
reports of streams that use Spark's watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelog.batches import BatchTable, compact, first_batch, read, write_batch
from tidelog.operators.health import merge_sessions, stall_sessions
from tidelog.session import complete_children, delete, stage, unstage


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in complete_children(spark, path) if n.startswith("batch_id="))


# Times are microseconds since 1970 wherever they pass through the driver, so no time zone touches them.

def _micros(span: dt.timedelta) -> int:
    return span // dt.timedelta(microseconds=1)


def seen_before(spark: SparkSession, path: str, number: int) -> int | None:
    """Greatest time of all batches before ``number``, as far as they were finished."""
    known = [n for n in _versions(spark, path) if n < number]
    if not known:
        return None
    return spark.read.schema("seen bigint").parquet(f"{path}/batch_id={known[-1]}").first()[0]


def note_seen(spark: SparkSession, path: str, number: int, seen: int | None) -> None:
    """Finish a batch: what the next one may take as seen.  Keeps the note before this one, for a repetition."""
    spark.createDataFrame([(seen,)], "seen bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
    for n in [n for n in _versions(spark, path) if n < number][:-1]:
        delete(spark, f"{path}/batch_id={n}")


def finished(spark: SparkSession, path: str) -> int:
    """The last batch that was finished, -1 if none."""
    return max(_versions(spark, path), default=-1)


def _latest(rows: DataFrame, ts: str, before: int | None) -> int | None:
    own = rows.agg(F.unix_micros(F.max(ts))).first()[0]
    return max((t for t in (own, before) if t is not None), default=None)


def split_late(rows: DataFrame, ts: str, watermark: int | None) -> tuple[DataFrame, DataFrame]:
    """``(on time, late)``: rows from ``watermark`` on, and those before it.  Rows without a time are late."""
    if watermark is None:
        return rows.where(F.col(ts).isNotNull()), rows.where(F.col(ts).isNull())
    on_time = F.coalesce(F.unix_micros(ts) >= F.lit(watermark), F.lit(False))
    return rows.where(on_time), rows.where(~on_time)


def _by_batch(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


# ---- replays, with a side output -----------------------------------------

def keys_table(spark: SparkSession, path: str) -> BatchTable:
    """Keys of what has been let through, by day, so that only the days of the delay are looked at."""
    return BatchTable(spark, path, "key binary, day date", by="day")


def ingest_once(rows: DataFrame, home: str, columns: tuple[str, ...], delay: dt.timedelta, checkpoint: str,
                ts: str = "collected_at", every: str | None = None) -> StreamingQuery:
    """One copy of rows that come again within ``delay``, and every row that comes too late to tell.

    Rows are the same if ``columns`` are equal, also where these are null.  Copies in a micro-batch are reduced by a partial
    aggregate, so a row that comes a million times does not meet in one task; the
    earliest stays.  What is left is compared with the keys of the last ``delay``.  Rows
    behind the watermark go to the late table, whole.
    See :func:`once_tables` for the results.
    """
    first = first_batch(once_tables(rows.sparkSession, home, rows, ts)[0], checkpoint)
    return _by_batch(rows, once_writer(home, columns, delay, ts, first), checkpoint, every)


def once_writer(home: str, columns: tuple[str, ...], delay: dt.timedelta, ts: str = "collected_at",
                first: int = 0) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of :func:`ingest_once`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        number, spark = first + batch_id, batch.sparkSession
        good, late, keys, seen = once_tables(spark, home, batch, ts)
        batch = stage(batch.withColumn("day", F.to_date(ts)), "arrived")
        try:
            before = seen_before(spark, seen, number)
            watermark = None if before is None else before - _micros(delay)
            on_time, behind = split_late(batch, ts, watermark)
            key = F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))
            keyed = on_time.withColumn("key", key)
            rest = [c for c in keyed.columns if c != "key"]
            once = keyed.groupBy("key").agg(F.min_by(F.struct(*rest), ts).alias("r")).select("key", "r.*")
            since = None if watermark is None else dt.datetime.fromtimestamp(watermark // 10 ** 6, dt.UTC).date().isoformat()
            known = read(keys, upto=number - 1, since=since).select("key").distinct()
            new = stage(once.join(known, "key", "left_anti"), "new")
            try:
                write_batch(late, behind, number)
                write_batch(keys, new.select("key", "day"), number)
                write_batch(good, new.drop("key"), number)
            finally:
                unstage(new)
            # Last: a batch that is repeated finds the watermark it had.
            note_seen(spark, seen, number, _latest(batch, ts, before))
        finally:
            unstage(batch)

    return write


def once_tables(spark: SparkSession, home: str, rows: DataFrame, ts: str = "collected_at") -> tuple[BatchTable, BatchTable, BatchTable, str]:
    """Rows let through, late rows, keys, and the folder of the watermark."""
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.drop("day").dtypes) + ", day date"
    return (BatchTable(spark, f"{home}/rows", fields, by="day"), BatchTable(spark, f"{home}/late", fields, by="day"),
            keys_table(spark, f"{home}/keys"), f"{home}/seen")


# ---- sessions, open ones shown -------------------------------------------

def closed_table(spark: SparkSession, home: str) -> BatchTable:
    """Sessions that are over, by the day they began."""
    return BatchTable(spark, f"{home}/closed", "source string, start timestamp, end timestamp, n bigint, day date", by="day")


def late_events_table(spark: SparkSession, home: str) -> BatchTable:
    """``(source, ts, n)`` of events behind the watermark, as many as came with that time."""
    return BatchTable(spark, f"{home}/late", "source string, ts timestamp, n bigint")


OPEN = "source string, start timestamp, end timestamp, n bigint"


def ingest_sessions(events: DataFrame, home: str, checkpoint: str, minutes: int = 20,
                    delay: dt.timedelta = dt.timedelta(hours=1), ts: str = "commit_time", source: str = "type",
                    every: str | None = None) -> StreamingQuery:
    """Live periods of every source, kept up by each micro-batch.

    A batch's events reduce to its own sessions, which merge with those that are
    open.  A session is over once no event that is on time could continue it; it
    then moves to the closed table and is not touched again.  So a batch rewrites
    the open sessions only, few for each source.  Events behind the watermark go to the late table.
    """
    first = first_batch(closed_table(events.sparkSession, home), checkpoint)
    return _by_batch(events, session_writer(home, minutes, delay, ts, source, first), checkpoint, every)


def session_writer(home: str, minutes: int = 20, delay: dt.timedelta = dt.timedelta(hours=1), ts: str = "commit_time",
                   source: str = "type", first: int = 0) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of :func:`ingest_sessions`."""
    patience = _micros(delay + dt.timedelta(minutes=minutes))

    def write(batch: DataFrame, batch_id: int) -> None:
        number, spark = first + batch_id, batch.sparkSession
        closed, late = closed_table(spark, home), late_events_table(spark, home)
        batch = stage(batch.select(F.col(source).cast("string").alias("source"), F.col(ts).alias("ts")), "live")
        try:
            before = seen_before(spark, f"{home}/seen", number)
            on_time, behind = split_late(batch, "ts", None if before is None else before - _micros(delay))
            pieces = stall_sessions(on_time, minutes, "ts", "source").unionByName(_open_sessions(spark, home, number - 1))
            merged = stage(merge_sessions(pieces, minutes), "sessions")
            try:
                now = _latest(batch, "ts", before)
                over = F.lit(False) if now is None else F.unix_micros("end") <= F.lit(now - patience)
                write_batch(late, behind.groupBy("source", "ts").agg(F.count("*").alias("n")), number)
                write_batch(closed, merged.where(over).withColumn("day", F.to_date("start")), number)
                merged.where(~over).write.mode("overwrite").parquet(f"{home}/open/batch_id={number}")
            finally:
                unstage(merged)
            # From here on readers take this batch's sessions.
            note_seen(spark, f"{home}/seen", number, now)
            for n in [n for n in _versions(spark, f"{home}/open") if n < number - 1]:
                delete(spark, f"{home}/open/batch_id={n}")
        finally:
            unstage(batch)

    return write


def _open_sessions(spark: SparkSession, home: str, number: int) -> DataFrame:
    if number < 0:
        return spark.createDataFrame([], OPEN)
    return spark.read.schema(OPEN).parquet(f"{home}/open/batch_id={number}")


def sessions(spark: SparkSession, home: str) -> DataFrame:
    """``(source, start, end, n, open)``: all sessions as of the last finished batch."""
    number = finished(spark, f"{home}/seen")
    over = read(closed_table(spark, home), upto=number).drop("day").withColumn("open", F.lit(False))
    return over.unionByName(_open_sessions(spark, home, number).withColumn("open", F.lit(True)))


def gather_sessions(spark: SparkSession, home: str) -> None:
    """Compact the closed and late tables as far as batches are finished."""
    number = finished(spark, f"{home}/seen")
    for table in (closed_table(spark, home), late_events_table(spark, home)):
        compact(table, upto=number)


# ---- Spark's own watermark -----------------------------------------------

class ProgressLog(StreamingQueryListener):
    """Stores what streams report: a row per micro-batch, however many there have been.

    ``spark.streams.addListener(ProgressLog(spark, path))`` before a stream starts.
    """

    SCHEMA = "query string, batch_id bigint, input_rows bigint, late_rows bigint, watermark string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        row = (str(p.id), p.batchId, p.numInputRows, late, (p.eventTime or {}).get("watermark"))
        (self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/stream={p.id}/report={p.batchId}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(cls.SCHEMA).parquet(path).select("query", "batch_id", "input_rows", "late_rows", "watermark")
