"""JSON lines and plain text lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.keys import strip
from tidelog.functions.once import with_once

# Python's JSON reader takes neither single quotes nor text after the object.
STRICT = {"allowSingleQuotes": "false"}


# Spark's JSON functions stop at the end of the first value and ignore what
# follows.  Reading the list [text, mark] instead makes any rest a syntax error
# or an extra element; the mark depends on the text, so no text can carry it.


def is_json(text: Column) -> Column:
    """Does the text hold exactly one JSON value?"""
    mark = F.xxhash64(text).cast("string")
    parts = F.from_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")),
                        "array<string>", STRICT)
    return F.coalesce((F.size(parts) == 2) & (F.get(parts, 1) == mark), F.lit(False))


def parse_lines(lines: DataFrame, schema: str, required: tuple[str, ...] = (),
                not_null: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``row`` and ``reject_reason`` to a DataFrame of text lines (``value``).

    A line must hold exactly one JSON object.  ``row`` follows ``schema``.  A
    ``required`` key must be present but may be null; a ``not_null`` key must be
    present and not null.  ``reject_reason`` is null for usable lines.
    """
    line, mark = F.col("value"), F.xxhash64("value").cast("string")
    marked = F.concat(F.lit("["), line, F.lit(',{"_mark":"'), mark, F.lit('"}]'))
    parsed = with_once(lines, "_parts", F.from_json(
        marked, f"array<struct<{schema}, _mark string>>", STRICT))
    parts = F.col("_parts")
    row = F.get(parts, 0)
    single = F.coalesce((F.size(parts) == 2) & (F.get(parts, 1)["_mark"] == mark), F.lit(False))
    reason = F.when(~single | row.isNull(), "malformed")
    for key in required:
        # The key list is only looked at when the value is null.
        present = row[key].isNotNull() | F.coalesce(
            F.array_contains(F.json_object_keys(line), key), F.lit(False))
        reason = reason.when(~present, f"missing {key}")
    for key in not_null:
        reason = reason.when(row[key].isNull(), f"null {key}")
    return parsed.withColumn("reject_reason", reason).withColumn(
        "row", row.dropFields("_mark")).drop("_parts")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select("row.*")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def ndjson_tolerant_scan(spark: SparkSession, path: str, schema: str,
                         **checks) -> tuple[DataFrame, DataFrame]:
    """JSON lines as ``(valid, rejected)``; malformed lines never fail the scan."""
    parsed = parse_lines(spark.read.text(path), schema, **checks)
    return accepted(parsed), rejected(parsed)


def lines_with(lines: DataFrame, marker: str) -> DataFrame:
    """Keep lines containing ``marker``: a cheap test ahead of any parsing."""
    return lines.where(F.col("value").contains(marker))


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, white space trimmed, blank lines dropped."""
    return spark.read.text(path).select(strip(F.col("value")).alias("id")).where("id <> ''")
