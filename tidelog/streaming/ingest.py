"""Commit and label frames into partitioned tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas
from tidelog.batches import BatchTable, first_batch, last_part, read, write_batch
from tidelog.functions.keys import endpoint_key, hash_bucket
from tidelog.operators import commits as C
from tidelog.operators.archive import day_path
from tidelog.operators.endpoints import keep_label_frames
from tidelog.session import stage, unstage
from tidelog.sources.lines import accepted, parse_lines, rejected


def events_of(frames: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Events of the usable commits; works on a stream and on a batch."""
    good, _ = C.split_dead_letters(C.keep_commit_frames(frames))
    return C.to_events(good, F.current_timestamp() if collected_at is None else collected_at)


def append_stream(rows: DataFrame, path: str, checkpoint: str, partition_by: str | None = None,
                  every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Start appending a stream to files, exactly once.

    Without ``every`` the query works off what has landed and ends; with it, a
    micro-batch is written per interval.  The checkpoint is the cursor: a restart
    continues after the last committed batch.
    """
    writer = rows.writeStream.format(fmt).outputMode("append").option(
        "checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def events_table(spark: SparkSession, path: str) -> BatchTable:
    """The table that :func:`ingest_commits` writes."""
    return BatchTable(spark, path, schemas.EVENT, by="collect_date", seq=F.col("seq"))


def lines_table(spark: SparkSession, path: str) -> BatchTable:
    """The table that :func:`ingest_day_lines` writes."""
    return BatchTable(spark, path, "value string, collect_date date", by="collect_date", fmt="text",
                      seq=F.get_json_object("value", "$.seq"))


def labels_table(spark: SparkSession, path: str) -> BatchTable:
    """The table that :func:`ingest_labels` writes: micro-batches in a few files, gathered ones by bucket."""
    return BatchTable(spark, path, "endpoint string, seq bigint, message string, endpoint_key string, bucket int",
                      by="bucket", seq=F.col("seq"), flat=True)


def batch_writer(events_path: str, dead_path: str, collected_at: Column | None = None,
                 first: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes events and dead letters."""
    return _batch_writer(lambda spark: events_table(spark, events_path), lambda events: events, dead_path,
                         collected_at, first)


def line_writer(lines_path: str, dead_path: str, collected_at: Column | None = None,
                first: int = 0) -> Callable[[DataFrame, int], None]:
    """The same for day lines: the text that the daily job reads once a day is closed."""
    return _batch_writer(lambda spark: lines_table(spark, lines_path), C.event_lines, dead_path, collected_at, first)


def _batch_writer(table: Callable[[SparkSession], BatchTable], form: Callable[[DataFrame], DataFrame], dead_path: str,
                  collected_at: Column | None, first: int) -> Callable[[DataFrame, int], None]:
    """Every batch owns the folder of its number and overwrites it whole, so a
    batch that is repeated after a failure does not write twice, whatever the clock
    says by then.  A line that is no frame, or a commit that cannot be used,
    goes to the dead letters with a reason and the stream moves on.  The ledger
    comes last: a batch that it names has all its rows and dead letters written.
    """
    when = F.current_timestamp() if collected_at is None else collected_at

    def write(batch: DataFrame, batch_id: int) -> None:
        if "value" in batch.columns:
            batch = parse_lines(batch, schemas.COMMIT)
        frames = stage(batch, "frames")
        raw, number = "value" in frames.columns, first + batch_id
        try:
            good, bad = C.split_dead_letters(C.keep_commit_frames(accepted(frames) if raw else frames))
            if raw:
                bad = bad.unionByName(rejected(frames).withColumnRenamed("reject_reason", "error"),
                                      allowMissingColumns=True)
            _write_dead(bad, dead_path, number)
            write_batch(table(frames.sparkSession), form(C.to_events(good, when)), number)
        finally:
            unstage(frames)

    return write


def _write_dead(bad: DataFrame, dead_path: str, number: int) -> None:
    if bad.limit(1).count():
        bad.write.mode("overwrite").parquet(f"{dead_path}/batch_id={number}")


def _start(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           every: str | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest_commits(frames: DataFrame, events_path: str, dead_path: str, checkpoint: str,
                   every: str | None = None, collected_at: Column | None = None) -> StreamingQuery:
    """Stream of commit frames, or of their raw lines, to an event table by batch and
    day; what cannot be used is set aside.

    A new checkpoint goes on with the number after the table's last batch; give it
    the frames :func:`after_seq` of the table's last sequence number.
    """
    first = first_batch(events_table(frames.sparkSession, events_path), checkpoint)
    return _start(frames, batch_writer(events_path, dead_path, collected_at, first), checkpoint, every)


def ingest_day_lines(lines: DataFrame, lines_path: str, dead_path: str, checkpoint: str,
                     every: str | None = None, collected_at: Column | None = None) -> StreamingQuery:
    """Stream of raw lines of commit frames to event lines by batch and day."""
    first = first_batch(lines_table(lines.sparkSession, lines_path), checkpoint)
    return _start(lines, line_writer(lines_path, dead_path, collected_at, first), checkpoint, every)


def close_day(spark: SparkSession, lines_path: str, raw: str, day: dt.date) -> None:
    """Gather a finished day's lines from all batches into the daily job's folder.

    The ledger names the batches and sets that hold lines of the day; no other
    folder is listed.  Many small files of micro-batches become few of bounded size; a
    repetition replaces them, with what came late.
    """
    found = read(lines_table(spark, lines_path), [day.isoformat()]).select("value")
    found.hint("rebalance").write.mode("overwrite").text(day_path(raw, day))


def after_seq(frames: DataFrame, seq: int | None) -> DataFrame:
    """Frames beyond a sequence number, to go on from the data when a checkpoint is gone.

    ``seq`` is the answer of ``resume_seq``, null for an empty table.
    """
    return frames if seq is None else frames.where(F.col("seq") > seq)


def newest_events(spark: SparkSession, events_path: str) -> DataFrame:
    """Events of the newest day of an ingested table, and of no other."""
    t = events_table(spark, events_path)
    return read(t, [p for p in [last_part(t)] if p is not None])


def late_rows(query: StreamingQuery) -> int:
    """Rows a query dropped because they came after its watermark, over the
    progress reports that Spark keeps."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in (p if isinstance(p, dict) else json.loads(p.json)).get("stateOperators", []))


def line_batch_writer(good_path: str, dead_path: str,
                      parse: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for raw lines, parsed as in ``parse_lines``."""
    def write(lines: DataFrame, batch_id: int) -> None:
        parsed = stage(parse(lines), "lines")
        try:
            accepted(parsed).write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
            rejected(parsed).write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")
        finally:
            unstage(parsed)

    return write


def ingest_lines(parsed: DataFrame, good_path: str, dead_path: str, checkpoint: str,
                 every: str | None = None) -> StreamingQuery:
    """A ``parsed_stream`` to frames and dead letters, both by batch."""
    return _start(parsed, line_batch_writer(good_path, dead_path, lambda lines: lines), checkpoint, every)


def ingest_labels(frames: DataFrame, path: str, dead_path: str, checkpoint: str, buckets: int = 64,
                  every: str | None = None) -> StreamingQuery:
    """All label endpoints through one query, whatever their number.

    Takes frames or their raw lines; a line that is no frame is a dead letter with a
    reason.  A micro-batch is written as it comes, in as many files as it has
    tasks; gathering it sorts messages into hash buckets of their endpoint.
    """
    spark = frames.sparkSession
    first = first_batch(labels_table(spark, path), checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        if "value" in batch.columns:
            parsed = stage(parse_lines(batch, schemas.LABEL), "label-lines")
            try:
                _write_dead(rejected(parsed).withColumnRenamed("reject_reason", "error"), dead_path, number)
                save(accepted(parsed), number)
            finally:
                unstage(parsed)
        else:
            save(batch, number)

    def save(batch: DataFrame, number: int) -> None:
        rows = keep_label_frames(batch).withColumn("endpoint_key", endpoint_key(F.col("endpoint")))
        rows = rows.withColumn("bucket", hash_bucket(F.col("endpoint_key"), buckets).cast("int"))
        write_batch(labels_table(batch.sparkSession, path),
                    rows.select("endpoint", "seq", "message", "endpoint_key", "bucket"), number)

    return _start(frames, write, checkpoint, every)
