"""Line dedup: lines that stand on many sites are boilerplate and go.

DataFrame operations only.  Each distinct line has one HyperLogLog sketch of the
sites it stands on; sketches of partitions merge by aggregation, so a line on
every page of a large site costs one row per input partition.  Lines whose
estimate is too near the threshold to trust get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.base import discard, stage

MIN_SITES = 10
LOG_REGISTERS = 12
#: Standard errors of the sketch within which an estimate is checked.
DOUBT = 6
LINE = ["line", "check", "n_bytes"]


def line_key(line: Column) -> Column:
    """Two independent hashes and the length stand for a line without its outer blanks."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("line"), F.hash(bare).alias("check"), F.octet_length(bare).alias("n_bytes"))


def owner() -> Column:
    """What a document's lines are gathered by: its id, or else a hash of its text.

    Two documents may share it, as all that is gathered is which lines are boilerplate.
    """
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def site_lines(docs: DataFrame, site: str) -> DataFrame:
    """One row per line that is not blank: its document, site and hashes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.select(owner().alias("owner"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
                        F.explode(F.split(text, "\n")).alias("words"))
            .filter(F.trim("words") != "").select("owner", "site", line_key(F.col("words")).alias("k"))
            .select("owner", "site", "k.*"))


def doubt_band(min_sites: int) -> tuple[float, float]:
    """Estimates between these, ends excluded, do not settle the question."""
    wide = max(1.0, DOUBT * 1.04 / 2 ** (LOG_REGISTERS / 2) * min_sites)
    return min_sites - wide - 1, min_sites + wide


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """The distinct lines that stand on at least ``min_sites`` sites."""
    low, high = doubt_band(min_sites)
    spread = stage(lines.groupBy(*LINE).agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"))
                   .select(*LINE, F.hll_sketch_estimate("sketch").alias("sites"))
                   .filter(F.col("sites") > low), "line-spread")
    near = spread.filter(F.col("sites") < high).select(*LINE)
    # Sites of the doubtful lines, made distinct before they are counted.
    sure = (lines.join(near, LINE, "left_semi").select(*LINE, "site").distinct()
            .groupBy(*LINE).count().filter(F.col("count") >= min_sites).select(*LINE))
    return spread.filter(F.col("sites") >= high).select(*LINE).unionByName(sure)


def drop_lines(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """Every document without its boilerplate lines.

    ``docs`` needs ``doc_id``, ``text`` and ``site``; other columns are ignored.
    Lines end with a line feed and are compared without outer blanks; blank lines
    always stay.  A null text is empty; a null site counts as one site, the same
    as an empty one; every line of a text counts, however long.  Result, one row per input row: ``doc_id``,
    ``n_lines``, ``n_removed`` and ``kept`` (the text that is left).  Rows that
    share a ``doc_id`` are treated each on its own text.
    """
    lines = stage(site_lines(docs, site), "site-lines")
    common = stage(boilerplate(lines, min_sites), "boilerplate")
    # What a document has to lose: the set holds boilerplate only, so rows that
    # share an id, or have none, can share it.
    loses = (lines.join(common, LINE).groupBy(F.col("owner").alias("__of"))
             .agg(F.collect_set(F.struct(*LINE)).alias("__loses")))
    loses = stage(loses, "boilerplate-by-document")
    discard(lines)
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       owner().alias("__of"))
    pieces = F.split("text", "\n")
    stays = F.when(F.col("__loses").isNull(), pieces).otherwise(
        F.filter(pieces, lambda p: ~F.array_contains(F.col("__loses"), line_key(p))))
    # One plan at every size: sets differ in width, so counting them bounds no broadcast.
    return (rows.join(loses.hint("merge"), "__of", "left")
            .select("doc_id", F.size(pieces).cast("long").alias("n_lines"), stays.alias("stays"))
            .select("doc_id", "n_lines", (F.col("n_lines") - F.size("stays")).alias("n_removed"),
                    F.array_join("stays", "\n").alias("kept")))
