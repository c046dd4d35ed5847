"""Tables written in micro-batches, with a ledger of their batches.

A batch owns the folder ``batch_id=N`` and overwrites it whole.  Once that is written, a
row per part (a day, a bucket) goes to the ledger: least and greatest sequence number and
how many rows.  A batch without its ledger row does not count.  So a reader never sees
half a batch, a cursor is a look at the ledger, and a day is read without listing the
batches of other days.

Many small batches are gathered by :func:`compact`: their rows go to a new *set* of
files by part, and one new ledger state puts the set in the place of the batches.
Nothing is moved or deleted on the way.  Who has planned a read before goes on
reading the batches; a compaction that dies leaves no trace and can be repeated;
a batch that its stream repeats after it was gathered is passed over.  One
compaction runs at a time, beside any number of readers and the stream that
writes.  :func:`sweep` removes what neither the newest state nor the one before it names.

Layout below the table's path: ``batch_id=N/[part]``, ``_sets/set=G/[part]``, and
``_ledger/batch_id=N`` and ``_ledger/state=G`` (small Parquet tables, complete with their success marker).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.session import child_names, complete_children, delete, write_complete

ENTRY = "part string, least_seq bigint, greatest_seq bigint, rows bigint"


@dataclass(frozen=True)
class State:
    """What has been gathered: batches up to ``upto``, now in ``sets``, as ``(set, part)``."""

    generation: int
    upto: int
    sets: list[tuple[int, str | None]] = field(default_factory=list)


@dataclass(frozen=True)
class BatchTable:
    """Where a table lies and what it holds.

    ``schema`` is DDL for all columns.  ``by`` names the column that parts a
    table, a date or a whole number; batches lie in one folder per part unless ``flat``.
    ``seq`` gives the sequence number of a stored row, if rows have one.  ``reduce`` makes
    rows that say the same one row: it is applied whenever rows of several batches meet, so
    applying it again must change nothing.
    """

    spark: SparkSession
    path: str
    schema: str
    by: str | None = None
    fmt: str = "parquet"
    seq: Column | None = None
    reduce: Callable[[DataFrame], DataFrame] | None = None
    flat: bool = False

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def fields(self) -> StructType:
        return StructType.fromDDL(self.schema)


def _entry_path(t: BatchTable, batch_id: int) -> str:
    return f"{t.path}/_ledger/batch_id={batch_id}"


def _state_path(t: BatchTable, generation: int) -> str:
    return f"{t.path}/_ledger/state={generation}"


def _numbers(names: Collection[str], key: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in names if re.fullmatch(key + r"=\d+", n))


def state(t: BatchTable, names: Collection[str] | None = None) -> State:
    """The newest complete state; its rows are one per set and part."""
    names = complete_children(t.spark, f"{t.path}/_ledger") if names is None else names
    found = _numbers(names, "state")
    if not found:
        return State(-1, -1)
    rows = _state_rows(t, found[-1]).select("upto", "set", "part", "rows").collect()
    return State(found[-1], max(r.upto for r in rows), [(r["set"], r.part) for r in rows if r.rows])


def _state_rows(t: BatchTable, generation: int) -> DataFrame:
    schema = f"upto bigint, set bigint, {ENTRY}"
    if generation < 0:
        return t.spark.createDataFrame([], schema)
    return t.spark.read.schema(schema).parquet(_state_path(t, generation))


def _open(names: Collection[str], upto: int) -> list[int]:
    return [n for n in _numbers(names, "batch_id") if n > upto]


def _entries(t: BatchTable, ids: list[int]) -> DataFrame:
    schema = f"batch_id bigint, {ENTRY}"
    if not ids:
        return t.spark.createDataFrame([], schema)
    return t.spark.read.schema(schema).parquet(*[_entry_path(t, n) for n in ids])


def ledger(t: BatchTable) -> DataFrame:
    """``(batch_id, set, part, least_seq, greatest_seq, rows)`` of everything that counts."""
    names = complete_children(t.spark, f"{t.path}/_ledger")
    now = state(t, names)
    none = F.lit(None).cast("bigint")
    gathered = _state_rows(t, now.generation).select(none.alias("batch_id"), "set", *_entry_columns())
    opened = _entries(t, _open(names, now.upto)).select("batch_id", none.alias("set"), *_entry_columns())
    return gathered.unionByName(opened).where("rows > 0")


def _entry_columns() -> list[str]:
    return [f.name for f in StructType.fromDDL(ENTRY)]


def _load(t: BatchTable, base: str, roots: list[str], parted: bool) -> DataFrame:
    """Rows below some folders of the table, with all its columns."""
    if not roots:
        return t.spark.createDataFrame([], t.schema)
    own = StructType([f for f in t.fields() if not (parted and f.name == t.by)])
    found = t.spark.read.format(t.fmt).option("basePath", base).schema(own).load(roots)
    return found.select([F.col(f.name).cast(f.dataType) for f in t.fields()])


def _summary(t: BatchTable, rows: DataFrame) -> DataFrame:
    """A ledger row per part of some stored rows."""
    seq = F.lit(None).cast("bigint") if t.seq is None else t.seq.cast("bigint")
    part = F.lit(None).cast("string") if t.by is None else F.col(t.by).cast("string")
    return rows.groupBy(part.alias("part")).agg(
        F.min(seq).alias("least_seq"), F.max(seq).alias("greatest_seq"), F.count("*").alias("rows"))


def _save(t: BatchTable, rows: DataFrame, path: str, parted: bool) -> DataFrame:
    """Write rows to a folder of their own and give back what is stored there."""
    if not parted:
        rows.write.mode("overwrite").format(t.fmt).save(path)
        return _load(t, path, [path], False)
    (rows.hint("rebalance", F.col(t.by)).write.mode("overwrite").partitionBy(t.by).format(t.fmt).save(path))
    some = any(n.startswith(f"{t.by}=") for n in child_names(t.spark, path))
    return _load(t, path, [path] if some else [], True)


def write_batch(t: BatchTable, rows: DataFrame, batch_id: int) -> bool:
    """Store a batch and note it in the ledger; False if it has been gathered already.

    Can be repeated: it overwrites what an earlier try left.
    """
    if batch_id <= state(t).upto:
        return False
    stored = _save(t, rows, t.folder(batch_id), t.by is not None and not t.flat)
    entry = _summary(t, stored).select(F.lit(batch_id).cast("bigint").alias("batch_id"), *_entry_columns())
    entry.coalesce(1).write.mode("overwrite").parquet(_entry_path(t, batch_id))
    return True


def read(t: BatchTable, parts: Collection[str] | None = None, upto: int | None = None,
         since: str | None = None) -> DataFrame:
    """All rows that count, or those of some parts, or of parts from ``since`` on, each once.

    Which folders these are is settled now; a compaction that comes before the
    rows are read does not change them.  ``upto`` leaves out later batches; what has been
    gathered is always in.
    """
    names = complete_children(t.spark, f"{t.path}/_ledger")
    now = state(t, names)
    ids = [n for n in _open(names, now.upto) if upto is None or n <= upto]
    if since is not None:
        held = _entries(t, ids).where("rows > 0").select("part").distinct().collect()
        held = {r.part for r in held} | {p for _, p in now.sets}
        parts = [p for p in held if p is not None and p >= since]
    found = _sets(t, [(s, p) for s, p in now.sets if parts is None or p in parts])
    found = found.unionByName(_batches(t, ids, parts))
    if parts is not None:
        found = found.where(F.col(t.by).cast("string").isin(list(parts)))
    return t.reduce(found) if t.reduce else found


def _batches(t: BatchTable, ids: list[int], parts: Collection[str] | None = None) -> DataFrame:
    """Rows of batches, from those folders only that the ledger says hold some."""
    full = _entries(t, ids).where("rows > 0")
    if parts is not None:
        full = full.where(F.col("part").isin(list(parts)))
    if t.by is None or t.flat:
        return _load(t, t.path, sorted(t.folder(r.batch_id) for r in full.select("batch_id").distinct().collect()), False)
    held = full.select("batch_id", "part").collect()
    return _load(t, t.path, sorted(f"{t.folder(r.batch_id)}/{t.by}={_folder_value(r.part)}" for r in held), True)


def _sets(t: BatchTable, pairs: list[tuple[int, str | None]]) -> DataFrame:
    base = f"{t.path}/_sets"
    roots = [f"{base}/set={s}" + (f"/{t.by}={_folder_value(p)}" if t.by else "") for s, p in pairs]
    return _load(t, base, roots, t.by is not None)


def _folder_value(part: str | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if part is None else part


def compact(t: BatchTable, upto: int | None = None) -> int | None:
    """Gather the batches up to ``upto``, by default all that are there; their new state, or None.

    Of a table that is reduced, the parts touched are rewritten together with what
    sets hold of them; of others a part gets one set more.  Parts without a new row stay as they are.
    """
    names = complete_children(t.spark, f"{t.path}/_ledger")
    now = state(t, names)
    ids = [n for n in _open(names, now.upto) if upto is None or n <= upto]
    if not ids:
        return None
    new = now.generation + 1
    rows = _batches(t, ids)
    replaced: list[tuple[int, str | None]] = []
    if t.reduce:
        # One row per part.
        touched = {r.part for r in _entries(t, ids).where("rows > 0").select("part").distinct().collect()}
        replaced = [(s, p) for s, p in now.sets if p in touched]
        rows = t.reduce(rows.unionByName(_sets(t, replaced)))
    stored = _save(t, rows, f"{t.path}/_sets/set={new}", t.by is not None)
    gone = F.lit(False)
    for s, p in replaced:
        gone = gone | ((F.col("set") == s) & F.col("part").eqNullSafe(F.lit(p)))
    # A row without a part keeps the place where there is nothing else to note.
    mark = t.spark.range(1).select(F.lit(None).cast("string").alias("part"), *[
        F.lit(None).cast("bigint").alias(c) for c in ("least_seq", "greatest_seq")], F.lit(0).cast("bigint").alias("rows"))
    ours = _summary(t, stored).unionByName(mark).withColumn("set", F.lit(new).cast("bigint"))
    kept = _state_rows(t, now.generation).where("rows > 0").where(~gone).select(*ours.columns)
    (kept.unionByName(ours).withColumn("upto", F.lit(ids[-1]).cast("bigint")).select("upto", "set", *_entry_columns())
     .coalesce(1).write.mode("overwrite").parquet(_state_path(t, new)))
    return new


def sweep(t: BatchTable) -> int:
    """Delete batches, sets and states that neither the newest state nor the one before it needs.

    A reader may thus be as old as the last compaction but one.  The number of folders deleted.
    """
    names = complete_children(t.spark, f"{t.path}/_ledger")
    known = _numbers(names, "state")
    if len(known) < 2:
        return 0
    now, before = state(t), state(t, {f"state={known[-2]}"})
    doomed = [p for n in _numbers(names, "batch_id") if n <= before.upto for p in (_entry_path(t, n), t.folder(n))]
    doomed += [_state_path(t, g) for g in known[:-2]]
    named = {*now.sets, *before.sets}
    for s in _numbers(child_names(t.spark, f"{t.path}/_sets"), "set"):
        used = {p for n, p in named if n == s}
        base = f"{t.path}/_sets/set={s}"
        # A set that no state names yet may be one that is being written.
        if s > known[-1]:
            continue
        if not used:
            doomed.append(base)
        elif t.by:
            keep = {f"{t.by}={_folder_value(p)}" for p in used}
            doomed += [f"{base}/{c}" for c in child_names(t.spark, base) if c.startswith(f"{t.by}=") and c not in keep]
    for path in doomed:
        delete(t.spark, path)
    return len(doomed)


def last_batch(t: BatchTable) -> int:
    """The greatest batch known, -1 for a new table."""
    names = complete_children(t.spark, f"{t.path}/_ledger")
    return max([state(t, names).upto, *_numbers(names, "batch_id")])


def first_batch(t: BatchTable, checkpoint: str) -> int:
    """The number this checkpoint's first batch has in the table.

    A stream counts its batches from 0 for every new checkpoint.  The first run
    notes the number beside the checkpoint's own files, so that it is lost together
    with them, and a new checkpoint goes on behind everything the table knows.
    """
    note = f"{checkpoint}/_first_batch"
    if not write_complete(t.spark, note):
        t.spark.range(1).select(F.lit(str(last_batch(t) + 1)).alias("value")).write.mode("overwrite").text(note)
    return int(t.spark.read.text(note).first()[0])


def last_part(t: BatchTable) -> str | None:
    """The greatest part that holds a row: of a table by day, the newest day."""
    return ledger(t).agg(F.max("part")).first()[0]


def resume_seq(t: BatchTable) -> DataFrame:
    """``(seq)``: greatest sequence number of the newest day, from the ledger alone."""
    rows = ledger(t)
    newest = rows.agg(F.max("part")).scalar()
    return rows.where(F.col("part") == newest).agg(F.max("greatest_seq").alias("seq"))
