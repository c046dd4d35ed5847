"""Writing results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.batches import BatchTable, compact, last_batch, read, state, write_batch
from tidelog.functions.keys import endpoint_key, hash_bucket
from tidelog.session import child_names

# A partition folder gets files of bounded size even when one partition holds a
# large share of the rows: the rebalance hint lets Spark split it over tasks.


def day_ndjson_sink(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Append ``(collect_date, value)`` lines to their day's folder."""
    (lines.hint("rebalance", F.col("collect_date")).write.mode(mode)
     .partitionBy("collect_date").text(path))


def endpoint_label_sink(labels: DataFrame, path: str, buckets: int = 64,
                        mode: str = "append") -> None:
    """Append label messages below a hash bucket of their endpoint's key."""
    keyed = labels.withColumn("endpoint_key", endpoint_key(F.col("endpoint")))
    bucket = hash_bucket(F.col("endpoint_key"), buckets).cast("int")
    (keyed.withColumn("bucket", bucket).hint("rebalance", F.col("bucket"))
     .write.mode(mode).partitionBy("bucket").json(path))


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; nulls are empty cells."""
    (df.write.mode(mode).option("header", True).option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def keyed_table(spark: SparkSession, path: str, buckets: int = 256) -> BatchTable:
    """The documents that :func:`keyed_json_sink` stores: ``(key, doc, version, bucket)``, the last version of each.

    The number of buckets is part of a folder's name; a table keeps the one it was
    made with, and another is refused.
    """
    others = [c for c in child_names(spark, path) if c.startswith("of_") and c != f"of_{buckets}"]
    if others:
        raise ValueError(f"{path} has {others[0][3:]} buckets, not {buckets}")
    return BatchTable(spark, f"{path}/of_{buckets}", "key string, doc string, version bigint, bucket int",
                      by="bucket", reduce=_last_versions, flat=True)


def _last_versions(docs: DataFrame) -> DataFrame:
    last = F.max(F.struct("version", "doc")).alias("v")
    return docs.groupBy("bucket", "key").agg(last).select("key", "v.doc", "v.version", "bucket")


def keyed_json_sink(docs: DataFrame, path: str, order: Column, key: str = "key",
                    doc: str = "doc", buckets: int = 256, due: int = 16) -> int:
    """Store one document per key, replacing the stored one of the same key; the update's number.

    An update is appended as it is, so it costs what it holds, and readers take the last version of
    a key.  It counts as a whole or not at all.  Once ``due`` updates have come together,
    they are gathered into the hash buckets they touch.  Of the rows of a key in one update the
    greatest ``order`` wins, of equal ones the larger document.
    """
    table = keyed_table(docs.sparkSession, path, buckets)
    number = last_batch(table) + 1
    last = F.max(F.struct(order.alias("o"), F.col(doc).alias("d")))["d"].alias("doc")
    update = docs.groupBy(F.col(key).cast("string").alias("key")).agg(last).select(
        "key", "doc", F.lit(number).cast("bigint").alias("version"), hash_bucket(F.col("key"), buckets).cast("int").alias("bucket"))
    write_batch(table, update, number)
    if number - state(table).upto >= due:
        compact(table)
    return number


def read_keyed(spark: SparkSession, path: str, buckets: int = 256, keys: DataFrame | None = None) -> DataFrame:
    """``(key, doc)``: the stored documents, or those of some keys."""
    found = read(keyed_table(spark, path, buckets))
    if keys is not None:
        found = found.join(keys.select(F.col("key").cast("string").alias("key")).distinct(), "key", "left_semi")
    return found.select("key", "doc")


def failure_ledger(failures: DataFrame, path: str) -> None:
    """Append failed ids; what is there is never rewritten."""
    failures.write.mode("append").parquet(path)


def read_failures(spark: SparkSession, path: str, schema: str, as_set: bool = False) -> DataFrame:
    """Every failure of a ledger, or each failed id once."""
    known = spark.read.schema(schema).parquet(path)
    return known.distinct() if as_set else known


def json_map_lines(lists: DataFrame, key: str = "pds", items: str = "items", pretty: bool = False) -> DataFrame:
    """``(value)``: one JSON object ``{key: items}`` per row, of bounded size; ``pretty`` ones have many lines."""
    return lists.select(F.to_json(F.create_map(F.col(key), F.col(items)), {"pretty": str(pretty).lower()}).alias("value"))
