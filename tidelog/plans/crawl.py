"""Identity log to servers, and listings to work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import keys
from tidelog.operators import identity, worklist


def servers_to_list(operation_lines: DataFrame, failed: DataFrame) -> DataFrame:
    """``(pds)``: servers whose repos are to be listed."""
    operations = identity.parse_operations(operation_lines)
    return worklist.skip_failed_pds(identity.distinct_pds(operations), failed)


def repos_to_fetch(repos: DataFrame, inventory: DataFrame, errors: DataFrame,
                   current: DataFrame, order: Column | None = None) -> DataFrame:
    """``(did, pds)``: repos still to be fetched, and where from."""
    todo = worklist.pending_repos(repos, inventory)
    return identity.pds_fallback(todo, errors, current, order)


def profiles_to_fetch(repos: DataFrame, inventory: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """``(pds, did)``: accounts whose profile and follow lists are missing or were cut off."""
    files = inventory.select(keys.file_key(F.col("path")).alias("k")).where(
        "k is not null").select("k.*")
    return worklist.pending_profiles(repos, worklist.profile_completeness(files, listings=listings))
