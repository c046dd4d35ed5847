"""A corpus pipeline: five stages over the documents table, each by one operator of ``tidelog.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept.  All but the last return the columns of ``docs``, whatever else those are.

Rows without id, or with the same id and different texts, are decided on one by
one.  Where a text decides alone, a row is known by its id and a hash of its text, so rows that
agree in both stay or go together; where rows are compared, each has a number, so
of rows that are repeated whole one stays.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, cut, decontam, exact, jaccard, langid
from tidelog.llm.base import checked, stage, table
from tidelog.llm.queries import sha256, vocabulary

#: A document goes when no language reaches this mean probability over its bytes.
#: A text that is half one language and half another still does.
LEAST_SCORE = 0.4
#: Near duplicates: five words a shingle, similarity of 0.8.
NEAR = jaccard.Rule(n=5, percent=80)


def row_key() -> Column:
    """Sorts by id, rows without id last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.xxhash64(F.col("text")).alias("text"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose keys are the only column of ``gone``.

    Texts are not shuffled as long as the keys are few enough to broadcast.
    """
    key = "__key"
    while key in docs.columns:
        key = "_" + key
    keys = checked(stage(gone.toDF(key).distinct(), "gone"))
    return docs.withColumn(key, row_key()).join(keys, key, "left_anti").drop(key)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts with a letter and one clear language; null and empty texts go."""
    learn = F.col("doc_id").isNotNull() & ~langid.held_out()
    model = langid.train(langid.sample(docs.select("doc_id", "text", "lang"), learn))
    seen = langid.predict(docs.select(row_key().alias("key"), "text"), model, "key")
    unclear = (F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < LEAST_SCORE)
    return without(docs, seen.filter(unclear).select("key"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for every row, and that column's name.

    Written out, so that a row has the same number whenever it is read.
    """
    number = "__row"
    while number in docs.columns:
        number = "_" + number
    return stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered"), number


def sort_key(number: str) -> Column:
    """Rows by id, those without one last; rows that share an id by their number."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(number).alias("row"))


def without_rows(rows: DataFrame, number: str, gone: DataFrame) -> DataFrame:
    """Numbered rows without those whose numbers are the only column of ``gone``, and without the number."""
    return rows.join(checked(stage(gone.toDF(number), "gone")), number, "left_anti").drop(number)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the best row of every group of equal texts, also of rows that are repeated whole."""
    rows, number = numbered(docs)
    groups = exact.exact_groups(rows.select(sort_key(number).alias("doc_id"), "text"))
    return without_rows(rows, number, groups.filter("not kept").select("doc_id.row"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row, by id, of every group of similar texts, rows that are repeated whole included.

    Texts without words all stay.
    """
    rows, number = numbered(docs)
    groups = jaccard.similar_groups(rows.select(F.col(number).alias("doc_id"), "text"), NEAR)
    linked = stage(groups.filter(F.col("component_id") != F.col("doc_id"))
                   .select(F.col("doc_id").alias(number), "component_id"), "linked")
    roots = linked.select(F.col("component_id").alias(number), "component_id").distinct()
    members = stage(linked.unionByName(roots).join(rows.select(number, sort_key(number).alias("key")), number)
                    .select("component_id", "key"), "members")
    best = checked(stage(members.groupBy("component_id").agg(F.min("key").alias("best")), "best"))
    gone = members.join(best, "component_id").filter(F.col("key.row") != F.col("best.row"))
    return without_rows(rows, number, gone.select("key.row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no window of ten words of a benchmark item."""
    found = decontam.find_items(docs.select(row_key().alias("key"), "text"), table(spark, sf_dir, "benchmark"), key="key")
    return without(docs, found.filter(F.size("hits") > 0).select("key"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, which decode to the text again."""
    back = bpe.roundtrip(docs, vocabulary(), cut.KNOWN)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       sha256(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", tokens),
]

#: None: a trained model and a tokenizer decide; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written out before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
