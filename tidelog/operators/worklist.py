"""What is still to be collected, and what came of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import keys
from tidelog.operators.ranking import bounded_lists
from tidelog.sources.lines import is_json

# Fixed value: the files a complete account has.
REQUIRED_KINDS = ("profile", "follows", "followers")
# Fixed value: most repos a listing page holds, also used as list size here.
PAGE_SIZE = 1000


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``work`` whose key is not in ``done``.

    Missing and empty keys are not work.  Both sides may be equally large, so the
    join strategy is left to the sizes Spark measures; a skewed work side is split.
    """
    usable = work.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return usable.join(done.select(key).distinct(), key, "left_anti")


def pending_audit_dids(dids: DataFrame, inventory: DataFrame) -> DataFrame:
    """``(did)``: listed accounts without an audit log; the list is made distinct."""
    done = inventory.select(keys.audit_key(F.col("path")).alias("did_key"))
    work = dids.select("did").distinct().withColumn("did_key", keys.did_key(F.col("did")))
    return pending(work, done, "did_key").select("did")


def pending_repos(repos: DataFrame, inventory: DataFrame) -> DataFrame:
    """``(pds, did)``: repos without a stored file; served-out servers vanish."""
    name = keys.file_name(F.col("path"))
    done = inventory.where(name.endswith(".txt")).select(
        F.regexp_replace(name, r"\.txt$", "").alias("did_key"))
    work = repos.withColumn("did_key", keys.did_key(F.col("did")))
    return pending(work, done, "did_key").drop("did_key")


def profile_completeness(files: DataFrame, required=REQUIRED_KINDS, listings: DataFrame | None = None) -> DataFrame:
    """``(did)``: accounts that have every required kind of file, whole.

    ``listings`` has ``(did, kind, complete)``, as from ``files.listing_complete``: a kind
    whose list was cut off does not count, though there is a file of it.  One flag
    per required kind, merged before the shuffle: the state per account
    has a fixed size however many files it has.
    """
    seen = files.select("did", "kind", F.lit(False).alias("cut"))
    if listings is not None:
        cut = ~F.coalesce("complete", F.lit(False))
        seen = seen.unionByName(listings.where(cut).select("did", "kind", F.lit(True).alias("cut")))
    # Null where the kind is missing, false where it was cut off.
    flags = [F.min(F.when(F.col("kind") == k, ~F.col("cut"))).alias(f"k{i}") for i, k in enumerate(required)]
    have = seen.where(F.col("kind").isin(*required)).groupBy("did").agg(*flags)
    everything = F.lit(True)
    for i in range(len(required)):
        everything = everything & F.col(f"k{i}")
    return have.where(everything).select("did")


def pending_profiles(repos: DataFrame, complete: DataFrame) -> DataFrame:
    """``(pds, did)``: repos of accounts that are not complete yet."""
    done = complete.select(F.col("did").alias("did_key"))
    work = repos.withColumn("did_key", keys.did_key(F.col("did")))
    return pending(work, done, "did_key").drop("did_key")


def skip_failed_pds(pds: DataFrame, failed: DataFrame) -> DataFrame:
    return pending(pds, failed, "pds")


def repos_by_pds(repos: DataFrame, chunk_size: int = PAGE_SIZE) -> DataFrame:
    """``(pds, chunk, items)``: repo lists per server, in bounded pieces.

    An item is ``(did, copies)``: a repo listed several times appears once with
    its number of listings.
    """
    once = repos.groupBy("pds", "did").agg(F.count("*").alias("copies"))
    return bounded_lists(once, "pds", "did", F.struct("did", "copies"), chunk_size)


def crawl_counts(repos: DataFrame) -> DataFrame:
    """``(pds, n_repos)``"""
    return repos.groupBy("pds").agg(F.count("*").alias("n_repos"))


def crawl_totals(repos: DataFrame) -> DataFrame:
    """``(n_pds, n_repos)``; the per-server counts are all that is totalled."""
    return crawl_counts(repos).agg(
        F.count("pds").alias("n_pds"), F.coalesce(F.sum("n_repos"), F.lit(0)).alias("n_repos"))


# Fixed value: answers that are valid JSON but hold nothing.
NOTHING = r"^\s*(\[\s*\]|\{\s*\}|null|\"\"|-?0(\.0+)?|false)\s*$"


def response_outcome(status: Column, body: Column) -> Column:
    """``stored``, ``empty`` for a good answer that holds nothing, else ``failed``."""
    good = F.coalesce((status == 200) & is_json(body), F.lit(False))
    return F.when(~good, "failed").when(body.rlike(NOTHING), "empty").otherwise("stored")


def fetch_results(dids: DataFrame, done: DataFrame, responses: DataFrame) -> DataFrame:
    """``(did, outcome)`` for every distinct account that was listed.

    Several answers for an account reduce to the best one before the join.
    """
    rank = {"stored": 1, "empty": 2, "failed": 3}
    names = F.create_map(*[F.lit(x) for name, r in rank.items() for x in (r, name)])
    ranks = F.create_map(*[F.lit(x) for name, r in rank.items() for x in (name, r)])
    best = responses.groupBy("did").agg(F.min(F.try_element_at(
        ranks, response_outcome(F.col("http_status"), F.col("body")))).alias("best"))
    before = done.select("did").distinct().withColumn("done", F.lit(True))
    return (dids.select("did").distinct().join(before, "did", "left").join(best, "did", "left")
            .select("did", F.when(F.col("done"), "done_before")
                    .when(F.col("best").isNull(), "not_asked")
                    .otherwise(F.try_element_at(names, F.col("best"))).alias("outcome")))


def fetch_outcomes(results: DataFrame) -> DataFrame:
    """``(outcome, n)``"""
    return results.groupBy("outcome").agg(F.count("*").alias("n"))


def follow_edges(follows: DataFrame, followers: DataFrame) -> DataFrame:
    """``(src, dst)``: who follows whom, from both stored lists, each edge once."""
    out = follows.select(F.col("did").alias("src"), F.explode("list").alias("dst"))
    back = followers.select(F.explode("list").alias("src"), F.col("did").alias("dst"))
    return out.unionByName(back).distinct()
