"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition belongs to one of ``RUNS`` runs.  A run holds one row per
distinct text: its digest, the best document so far and the number of copies.
In each round ``FAN_IN`` neighbouring runs are merged into one, as in a binomial
tree: run ``r`` goes to run ``r // FAN_IN``.  The rows of a run are spread over
all tasks by digest, so no task ever holds a whole run, and the sort aggregate
that merges them reads its input in digest order.  A text with a third of all
rows counts once per input partition from the first round on.

Equality is verified at every level: rows merge only where the SHA-256 digest,
a second independent hash and the byte length all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.base import stage

# Fixed values of the definition of equality: the characters that do not count.
BLANKS = r"[\x20\x09-\x0D]+"
RUNS = 64
FAN_IN = 4
KEY = ["digest", "check", "n_bytes"]


def digest_rows(docs: DataFrame) -> DataFrame:
    """Per document: id, order of preference, run, and what identifies its text."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.regexp_replace(body, BLANKS, "")
    return (docs.select(F.col("doc_id"), F.char_length(body).alias("n_chars"), bare.alias("bare"))
            .select("doc_id", "n_chars", F.monotonically_increasing_id().alias("row"), F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
                    F.unhex(F.sha2("bare", 256)).alias("digest"), F.xxhash64("bare").alias("check"),
                    F.octet_length("bare").alias("n_bytes")))


def first_runs(rows: DataFrame) -> DataFrame:
    """One row per run and distinct text.  The best row sorts first: most code
    points, then smallest id; a null id is the last choice.  Of rows that agree in all
    of that, the one with the smallest row number."""
    best = F.struct((-F.col("n_chars")).alias("order"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    return rows.groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))


def merge_round(runs: DataFrame) -> DataFrame:
    """Merge each ``FAN_IN`` neighbouring runs into one."""
    return (runs.withColumn("run", F.floor(F.col("run") / FAN_IN))
            .groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size")))


def exact_groups(docs: DataFrame) -> DataFrame:
    """The group of equal texts of every document.

    ``docs`` needs ``doc_id`` (of any type that can be sorted) and ``text``; other columns are ignored, whatever
    their names.  A null text counts as empty, so empty, blank and null texts
    form one group.  Result, one row per input row: ``doc_id``, ``keep_id``,
    ``group_size`` (rows), ``kept`` and ``text_sha256``.  One row of a group is
    kept, also where rows share a ``doc_id`` or are repeated whole.  A null
    ``doc_id`` is kept only if its whole group has none.  An empty table gives
    an empty result.
    """
    rows = stage(digest_rows(docs), "exact-rows")
    runs, left = first_runs(rows), RUNS
    while left > 1:
        runs, left = merge_round(runs), -(-left // FAN_IN)
    # Written out, both join sides are plain exchanges, so that a partition with
    # a hot text can be split at run time.
    texts = stage(runs.select(*KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"), "exact-texts")
    return (rows.join(texts, KEY)
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))

