"""Token shards in training order.

Every text's token ids end with ``END`` and are cut into sequences of ``length``
tokens.  A sequence's number, made of its row's number and its place in the
document, goes through a keyed permutation of all such numbers: a Feistel network
over the next power of four, walked on while it leaves the range.  The permuted
numbers are dealt to shards by range, and a sequence's slot is its rank among
all of them.  Rows are numbered by their ids, or densely by ids and texts
(``numbered``) where ids are missing, repeated or far apart; the order depends on
these and the key alone, never on how the input is partitioned or how many shards
there are.

A shard is one file of records of equal length, written by Spark's own writer
and committed with it: slot ``s`` of a shard that begins at slot ``f`` is at byte
``(s - f) * stride``.  A reader goes on at any slot by seeking there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.base import checked, small_batches, stage
from tidelog.llm.words import mix
from tidelog.operators.ranking import with_position

#: Ids beside the vocabulary's: the end of a text, and filling.
END, PAD = 50256, 65535
HEADER = 16  # document id (8 bytes), place in the document (4), number of tokens (4), all big-endian
NO_ID = -(1 << 63)
SEPARATOR = "\n"  # Spark's text writer ends every record with it
#: Rows repeated whole are handed out in pieces of so many.
PIECE = 1000
#: Records of an Arrow batch, on the way to the shards and back.
BATCH = 1000
HEAD = np.dtype([("id", ">i8"), ("part", ">i4"), ("n", ">i4")])


@dataclass(frozen=True)
class Order:
    """A keyed permutation of the numbers below ``size``."""

    size: int
    key: int
    rounds: int = 6

    @property
    def half(self) -> int:
        return max(1, (max(self.size - 1, 1).bit_length() + 1) // 2)

    def _feistel(self, x: np.ndarray) -> np.ndarray:
        bits, low = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> bits, x & low
        for r in range(self.rounds):
            salt = np.uint64((self.key * 0x9E3779B97F4A7C15 + r * 0xD6E8FEB86659FD93) % (1 << 64))
            left, right = right, left ^ (mix(right + salt) & low)
        return left << bits | right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Places of the numbers ``x``; walks on, along the permutation's own cycle,
        while a place lies outside the range."""
        out = self._feistel(x.astype(np.uint64))
        while len(beyond := np.flatnonzero(out >= np.uint64(self.size))):
            out[beyond] = self._feistel(out[beyond])
        return out


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """``number``, ``doc_id`` and ``text`` of every row, and how many rows there are.

    Numbers are dense from 0, in the order of a 128-bit hash of id and text.  Rows
    repeated whole have numbers of their own that follow each other; as such rows
    are alike, it does not matter which has which.  Texts are not shuffled as long
    as the numbers are few enough to broadcast.
    """
    rows = docs.select("doc_id", "text")
    same = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    rows = rows.select(F.xxhash64(*same).alias("k"), F.xxhash64(F.lit(1), *same).alias("check"), "*")
    counts = stage(rows.groupBy("k", "check").agg(F.count(F.lit(1)).alias("n")), "row-counts")
    # Pieces are dealt out before they become rows, so that a hot row is spread.
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PIECE}")))
    cut = counts.select("k", "check", "n", pieces.alias("piece")).repartition("k", "check", "piece")
    copies = F.explode(F.sequence(F.col("piece") * PIECE, F.least(F.col("piece") * PIECE + PIECE, F.col("n")) - 1))
    each = cut.select("*", copies.alias("copy")).select("piece", F.col("n").alias("of"), F.struct("k", "check", "copy").alias("row"))
    places = stage(with_position(each, "row", "number").select("row.k", "row.check", "piece", "of", "number"), "row-numbers")
    total = places.count()
    again = counts.filter("n > 1").select("k", "check", "n")
    # Rows that are there once find their number; of the others one is kept and dealt out again.
    out = rows.join(checked(stage(places.filter("of = 1").select("k", "check", "number"), "numbers-once")), ["k", "check"])
    out = out.select("number", "doc_id", "text")
    if again.limit(1).count():
        repeated = (rows.join(checked(stage(again, "rows-again")), ["k", "check"])
                    .groupBy("k", "check", "n").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
                    .select("k", "check", "doc_id", "text", pieces.alias("piece")).repartition("k", "check", "piece"))
        more = checked(stage(places.filter("of > 1").select("k", "check", "piece", "number"), "numbers-again"))
        out = out.unionByName(repeated.join(more, ["k", "check", "piece"]).select("number", "doc_id", "text"))
    return out, total


def _records(head: np.ndarray, size: np.ndarray, tokens: np.ndarray) -> pa.Array:
    """Each header with as many of the tokens, which follow each other, behind it."""
    ends = np.cumsum(size + HEADER // 2)
    at = (ends - size - HEADER // 2)[:, None] + np.arange(HEADER // 2)
    out = np.empty(int(ends[-1]), "<u2")
    rest = np.ones(len(out), bool)
    rest[at.ravel()] = False
    out[at] = head.view("<u2").reshape(at.shape)
    out[rest] = tokens
    offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _sequences(length: int, order: Order, first: int, most: int, shards: int) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """From a batch of rows (``doc_id`` and ``number`` in a struct) and ids to shard, place and
    record of every sequence, ``BATCH`` at a time; records are not filled yet."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        doc_ids, numbers = batch.column(0).flatten()
        ends = batch.column(1).offsets.to_numpy().astype(np.int64)
        own = np.insert(batch.column(1).values.to_numpy()[ends[0]: ends[-1]], ends[1:] - ends[0], END).astype("<u2")
        n = np.diff(ends) + 1
        parts = -(-n // length)
        owner = np.repeat(np.arange(len(n)), parts)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        size = np.minimum(n[owner] - part * length, length)
        to = np.concatenate([[0], np.cumsum(size)])
        known = numbers.is_valid().to_numpy(zero_copy_only=False)
        base = np.where(known, numbers.fill_null(first).to_numpy(zero_copy_only=False) - first + 1, 0) * most
        place = order((base[owner] + part).astype(np.uint64)).astype(np.int64)
        exact = place if order.size * shards < 1 << 63 else place.astype(object)
        shard = (exact * shards // order.size).astype(np.int32)
        head = np.empty(len(owner), HEAD)
        head["id"] = doc_ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)[owner]
        head["part"], head["n"] = part, size
        for a in range(0, len(owner), BATCH):
            b = min(a + BATCH, len(owner))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(shard[a:b]), "place": pa.array(place[a:b]),
                "record": _records(head[a:b], size[a:b], own[to[a]: to[b]])})

    return run


def filled(record: str, length: int) -> Column:
    """Records at full length: the fill token is one byte, twice."""
    return F.rpad(record, HEADER + 2 * length, F.lit(bytes([PAD & 0xFF])))


def stride(length: int) -> int:
    return HEADER + 2 * length + len(SEPARATOR)


def write_shards(tokens: DataFrame, path: str, length: int, shards: int, key: int, upper: int,
                 ids: tuple[int, int], number: str = "doc_id", encode: Callable[..., DataFrame] | None = None) -> None:
    """Write every row of ``tokens`` (``doc_id``, a whole number, and ``ids``, below 2**16) to ``path``.

    With ``encode`` (``bpe.encode``, its vocabulary and pattern given) rows have a ``text``
    instead of ``ids``; it is encoded and cut in one Python worker, so that a core has one
    worker for both and only records leave it.

    ``upper`` bounds the tokens of one row, its end included, and ``ids`` holds the
    smallest and the largest value of the column ``number``; both only say which numbers
    are permuted.  Null ids of documents and empty or null token lists are legal: a row
    without tokens is one sequence with the end alone.  Rows with one number, or none, have
    the same places and follow each other in the order of their records.  Shards get equal
    ranges of places, so their sizes are even if every row has a number of its own, as
    ``numbered`` gives.  An empty table writes no shard.
    """
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col(number).cast("long").alias("number")).alias("row")
    small_batches(tokens.sparkSession)
    first, last = ids
    most = -(-upper // length)
    size = (last - first + 2) * most
    if size >= 1 << 62:
        raise ValueError("document ids are too far apart to number their sequences in 62 bits")
    order = Order(size, key)
    cut, made = _sequences(length, order, first, most, shards), "shard int, place long, record binary"
    if encode:
        dealt = encode(tokens.select(row, "text"), key="row", onward=(cut, made))
    else:
        rows = tokens.select(row, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
        dealt = rows.mapInArrow(lambda batches: (out for batch in batches for out in cut(batch)), made)
    (dealt.repartition(shards, "shard").sortWithinPartitions("shard", "place", "record")
     .select("shard", filled("record", length).cast("string").alias("value"))
     .write.partitionBy("shard").option("lineSep", SEPARATOR).text(path))


def read_shards(spark: SparkSession, path: str, length: int) -> DataFrame:
    """Every record of the shards under ``path`` in slots: ``slot``, ``shard``, ``offset``
    (bytes into the shard), ``doc_id``, ``part``, ``n_tokens`` and ``tokens`` (16-bit, little-endian, unfilled).

    A task holds as many whole shards at a time as fit a file split; a training
    job that streams one shard uses ``read_from``.
    """
    width = stride(length)
    files = spark.read.format("binaryFile").load(path)
    # One row per shard, from the files' lengths alone: its first slot.
    sizes = files.select(F.col("shard").cast("int").alias("shard"), F.floor(F.col("length") / width).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_py()
                rows = np.frombuffer(raw, np.dtype([*HEAD.descr, ("rest", f"V{width - HEADER}")]))
                at = np.arange(len(rows), dtype=np.int64) * width
                ends = at + HEADER + 2 * rows["n"]
                for a in range(0, len(rows), BATCH):
                    own, o, e = rows[a: a + BATCH], at[a: a + BATCH], ends[a: a + BATCH]
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(own), shard, np.int32)), "offset": pa.array(o),
                        "id": pa.array(own["id"].astype(np.int64)), "part": pa.array(own["part"].astype(np.int32)),
                        "n_tokens": pa.array(own["n"].astype(np.int32)),
                        "tokens": pa.array([raw[x + HEADER: y] for x, y in zip(o.tolist(), e.tolist(), strict=True)], pa.binary())})

    records = files.select(F.col("shard").cast("int").alias("shard"), "content").mapInArrow(
        run, "shard int, offset long, id long, part int, n_tokens int, tokens binary")
    return records.join(F.broadcast(firsts), "shard").select(
        (F.col("first") + F.expr(f"offset div {width}")).alias("slot"), "shard", "offset",
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "part", "n_tokens", "tokens")


def read_from(file, slot: int, first: int, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Resume in an open shard file that begins at slot ``first``: document id and tokens from ``slot`` on."""
    file.seek((slot - first) * stride(length))
    while record := file.read(stride(length)):
        n = int.from_bytes(record[12:16], "big")
        yield int.from_bytes(record[:8], "big", signed=True), np.frombuffer(record, "<u2", n, HEADER)
