"""File inventories, CSV lists, JSON maps and listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.batches import BatchTable, first_batch, write_batch


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below ``path``.

    File contents are never read: the scan is pruned to the three columns.  Spark
    leaves empty files out, which suits a set of finished results.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))


def inventory_table(spark: SparkSession, path: str) -> BatchTable:
    """An inventory that is kept up, by the UTC day files were written."""
    return BatchTable(spark, path, "path string, length bigint, modificationTime timestamp, day date", by="day")


def update_inventory(spark: SparkSession, path: str, table: BatchTable, checkpoint: str,
                     max_files: int | None = None) -> None:
    """Add the files that are new below ``path`` to an inventory.

    A stream of file names: its checkpoint knows the files of earlier runs, so a run has rows for new ones only, spread
    over tasks, and a run that dies goes on where it was.  Contents are not
    read.  A file is taken once; finished results are not rewritten.
    """
    first = first_batch(table, checkpoint)
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
    found = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(table, batch.select("path", "length", "modificationTime", F.to_date("modificationTime").alias("day")),
                    first + batch_id)

    (found.drop("content").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def latest_file(inventory: DataFrame) -> DataFrame:
    """Newest file by modification time; the larger path wins a tie."""
    newest = F.max(F.struct("modificationTime", "path"))
    return inventory.agg(newest["path"].alias("path"))


def csv_endpoints(spark: SparkSession, path: str) -> DataFrame:
    """``(handle, did, service_endpoint)`` from CSV files with a header."""
    return spark.read.option("header", True).schema(schemas.ENDPOINT_CSV).csv(path)


def json_map_rows(docs: DataFrame, value_type: str, column: str = "value") -> DataFrame:
    """``(key, value)`` for every entry of the JSON objects in ``column``."""
    entries = F.from_json(column, f"map<string,{value_type}>")
    return docs.select(F.explode(entries).alias("key", "value"))


# A line break cannot stand inside a JSON string, so every line begins outside of strings: what a
# line does to the nesting depth can be told from the line alone.
_STRINGS = r'"(?:[^"\\]++|\\.)*+"'


def json_map_scan(spark: SparkSession, path: str, value_type: str,
                  whole_files: bool = False) -> DataFrame:
    """Entries of landed JSON maps.

    One object per line splits over tasks at any size.  ``whole_files`` reads
    objects over many lines, any number of them in a file; such a file splits as well, see
    :func:`json_map_entries`.
    """
    if whole_files:
        return json_map_rows(json_map_entries(spark, path), value_type)
    return json_map_rows(spark.read.text(path), value_type)


def json_map_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: JSON objects of one or a few entries each, cut out of objects of any size.

    A file is read in splits, line by line.  The nesting depth at the start of a
    line is a prefix sum of what the lines before it add: inside a split by a window,
    and over splits from one row for each.  An object is cut before lines that
    start at depth one behind a comma, or at depth zero, so a cut never lies in an entry;
    entries that share a line stay together.  Only one entry, never a file, has to fit a task.
    """
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"))
    bare = F.regexp_replace("value", _STRINGS, "")


    def many(these: str) -> Column:
        return F.char_length(bare) - F.char_length(F.translate(bare, these, ""))

    # Blank lines keep their place but change nothing.
    lines = text.withColumn("delta", many("{[") - many("}]")).withColumn(
        "tail", F.expr("nullif(right(rtrim(' \t\r', value), 1), '')"))
    inside = Window.partitionBy("file", "split").orderBy("at")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.select("*", F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("rise"),
                          F.last("tail", ignorenulls=True).over(before).alias("behind"))
    splits = lines.groupBy("file", "split").agg(F.sum("delta").alias("delta"), F.max_by("tail", F.when(
        F.col("tail").isNotNull(), F.col("at"))).alias("tail"))
    # A row per split of a file.
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("delta").over(earlier), F.lit(0)).alias("base"),
                           F.last("tail", ignorenulls=True).over(earlier).alias("behind_split"))
    known = placed.join(splits, ["file", "split"]).withColumn("depth", F.col("base") + F.col("rise")).withColumn(
        "behind", F.coalesce("behind", "behind_split"))
    starts = F.col("tail").isNotNull() & ((F.col("depth") == 0) | ((F.col("depth") == 1) & F.col("behind").isin(",", "{")))
    # A chunk is known by its first line; lines before the first cut of a split belong to the last one before.
    mark = F.when(starts, F.struct("split", "at"))
    cut = known.withColumn("_mark", mark).withColumn("first", F.last("_mark", ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, 0)))
    carried = cut.groupBy("file", "split").agg(F.max("_mark").alias("last")).select(
        "file", "split", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    opened = F.when(F.col("depth") == 0, F.regexp_replace("value", r"^\s*\{", "")).otherwise(F.col("value"))
    closed = F.when(F.col("depth") + F.col("delta") == 0, F.regexp_replace(opened, r"\}\s*,?\s*$", "")).otherwise(opened)
    rows = cut.join(carried, ["file", "split"]).select(
        "file", F.coalesce("first", "carried").alias("chunk"), "split", "at", closed.alias("value"))
    chunks = rows.where("chunk is not null").groupBy("file", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
    entries = F.regexp_replace(F.array_join("lines.value", "\n"), r",\s*$", "")
    return chunks.select(F.concat(F.lit("{"), entries, F.lit("}")).alias("value"))


def listing_complete(pages: DataFrame, key: str, ended: Column) -> DataFrame:
    """``(key, n_pages, complete)``: did the listing of a key reach its end?

    ``ended`` marks a page that names no further one.  Pages are numbered from 0;
    a listing that lacks a page, or whose last page is not an end, was cut off.
    """
    seen = pages.groupBy(key, "page_no").agg(F.bool_or(F.coalesce(ended, F.lit(False))).alias("ended"))
    last = F.max(F.struct("page_no", "ended"))
    return seen.groupBy(key).agg(F.count("*").alias("n_pages"), last.alias("last")).select(
        key, "n_pages", (F.col("last.ended") & (F.col("last.page_no") + 1 == F.col("n_pages"))).alias("complete"))


def paged_listing(pages: DataFrame, key: str) -> DataFrame:
    """``(key, page_no, pos, item)``: items of all listing pages of a key.

    The order of a key's list is ``(page_no, pos)``; nothing is collected.
    """
    return pages.select(key, "page_no", F.posexplode("items").alias("pos", "item"))
