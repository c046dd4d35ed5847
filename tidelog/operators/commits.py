"""Commit frames to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import keys, records, times


def keep_commit_frames(frames: DataFrame) -> DataFrame:
    """Only commit frames that carry blocks."""
    return frames.where((F.col("kind") == "commit") & (F.size("blocks") > 0))


def attach_records(commits: DataFrame) -> DataFrame:
    """Give every op its record JSON: the block of the same commit with its cid.

    The lookup happens inside the row, before ops are exploded, so the block map
    is neither shuffled nor copied once per op.  Ops without a block keep a null.
    """
    return commits.withColumn("ops", F.transform("ops", lambda op: op.withField(
        "record_json", F.when(op["cid"].isNotNull(), F.try_element_at("blocks", op["cid"])))))


def explode_ops(commits: DataFrame) -> DataFrame:
    """One row per op, with the fields of the op and of its commit.

    A commit without ops gives no row.
    """
    rest = [c for c in commits.columns if c not in ("ops", "blocks")]
    return (commits.select(*rest, F.posexplode("ops").alias("op_no", "op"))
            .select(*rest, "op_no", "op.*"))


def split_dead_letters(commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: commits whose time or op list is unusable go aside."""
    marked = commits.withColumn("commit_time", times.parse_event_time(F.col("time"))).withColumn(
        "error", F.when(F.col("commit_time").isNull(), "bad time")
        .when(F.col("ops").isNull(), "no op list"))
    good = marked.where(F.col("error").isNull()).drop("error")
    bad = marked.where(F.col("error").isNotNull()).drop("commit_time")
    return good, bad


def to_events(good_commits: DataFrame, collected_at: Column) -> DataFrame:
    """Events of commits that passed :func:`split_dead_letters`.

    A record that is not valid JSON leaves the event in place with a null record
    and a ``parse_error``.
    """
    ops = explode_ops(attach_records(good_commits.withColumn("collected_at", collected_at)))
    record = F.try_parse_json("record_json")
    broken = F.col("record_json").isNotNull() & record.isNull()
    return ops.select(
        "seq", "collected_at", "commit_time", F.col("time").alias("commit_time_str"), "action",
        keys.collection(F.col("path")).alias("type"),
        keys.event_uri(F.col("repo"), F.col("path")).alias("uri"),
        F.col("repo").alias("author"), "cid", record.alias("record"),
        F.when(broken, "record is not valid JSON").alias("parse_error"),
        times.collect_date(F.col("collected_at")).alias("collect_date"))


def record_overlay(events: DataFrame, names: list[str]) -> DataFrame:
    """View of the events in which record fields replace envelope fields."""
    return events.withColumns(
        {n: records.overlay(F.col("record"), n, F.col(n)) for n in names})


def event_lines(events: DataFrame) -> DataFrame:
    """``(collect_date, value)``: each event as one flat JSON line.

    Record fields are merged over the envelope; non-ASCII text is escaped.  Most
    records share no name with the envelope, and theirs is appended to it as
    text; only the others are merged field by field.
    """
    # Epoch seconds to the microsecond, printed as plain numbers.
    envelope = {
        "seq": F.col("seq"),
        "collected_at": F.col("collected_at").cast("decimal(20,6)"),
        "collected_at_str": times.format_event_time(F.col("collected_at")),
        "commit_time": F.col("commit_time").cast("decimal(20,6)"),
        "commit_time_str": F.col("commit_time_str"),
        "action": F.col("action"),
        "type": F.col("type"),
        "uri": F.col("uri"),
        "author": F.col("author"),
        "cid": F.col("cid"),
    }
    nulls = {"ignoreNullFields": "false"}
    clash = F.coalesce(*[F.try_variant_get("record", f"$.{n}", "variant") for n in envelope]).isNotNull()
    # Used several times below, so they are columns of their own.
    rows = events.withColumns({
        "_head": F.to_json(F.struct(*[v.alias(n) for n, v in envelope.items()]), nulls),
        "_own": F.to_json("record"), "_clash": clash})

    fields = F.create_map(*[x for n, v in envelope.items() for x in (F.lit(n), v.cast("variant"))])
    record = F.col("record").try_cast("map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: ~F.map_contains_key(record, k))
    merged = F.to_json(F.map_concat(kept, record), nulls)

    line = (F.when(F.col("_clash"), merged)
            .when(F.col("_own").startswith('{"'), F.concat(
                F.expr("left(_head, length(_head) - 1)"), F.lit(","),
                F.expr("right(_own, length(_own) - 1)")))
            .otherwise(F.col("_head")))
    return rows.select("collect_date", line.alias("_line")).select(
        "collect_date", records.ascii_json(F.col("_line")).alias("value"))


def block_rows(repos: DataFrame) -> DataFrame:
    """``(did, cid, block)``: one row per block of a repo."""
    return repos.select("did", F.explode("blocks").alias("cid", "block"))


def replay_dedup(events: DataFrame, keys_: tuple[str, ...] = ("seq", "uri", "action")) -> DataFrame:
    """One copy of every event delivered more than once.

    Copies collapse inside each input partition before the shuffle, so a group
    of any number of copies reaches its task as one row per partition.
    """
    return events.dropDuplicates(list(keys_))
