"""Positions in a total order, and lists in bounded pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.keys import hash_bucket
from tidelog.session import stage


def with_position(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """Add the 0-based position of every row in the order of a unique ``key``.

    An unpartitioned window would sort everything in one task.  Here the rows are
    range-partitioned and sorted in parallel, numbered inside their partition,
    and shifted by the number of rows in the partitions before theirs.  The
    numbered rows are staged so that both reads see the same partitions.
    """
    sorted_ = df.repartitionByRange(key).sortWithinPartitions(key)
    row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = stage(sorted_.select(
        "*", F.spark_partition_id().alias("_part"), row_in_part.alias("_row")), "positions")
    # One row per partition: as many as spark.sql.shuffle.partitions at most.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_row"))
            .drop("_part", "_row", "_offset"))


def bounded_lists(df: DataFrame, key: str, item: str, item_value: Column,
                  chunk_size: int) -> DataFrame:
    """``(key, chunk, items)``: the items of a key in pieces of about ``chunk_size``.

    A key can own a third of all rows, so its list is never built whole.  The
    number of pieces follows from the key's size, and an item's piece from a hash
    of the item.  ``df`` holds each ``(key, item)`` once.

    The table of sizes is staged: Spark then knows how large it is and only joins
    by shuffling on the key when it has outgrown a broadcast.  The pieces are then
    dealt out by key and piece, so a large key's items are spread over the tasks
    that build lists, and AQE can split its partition of the join.  A null key has lists like any other.
    """
    df = stage(df, "list-items")
    sizes = df.groupBy(key).agg(F.ceil(F.count("*") / F.lit(chunk_size)).alias("_pieces"))
    sizes = stage(sizes, "list-sizes").withColumnRenamed(key, "_key")
    placed = df.join(sizes, df[key].eqNullSafe(sizes["_key"])).withColumn(
        "chunk", hash_bucket(F.col(item), F.col("_pieces"))).drop("_key", "_pieces")
    placed = placed.repartition(key, "chunk")
    return placed.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(item_value)).alias("items"))
