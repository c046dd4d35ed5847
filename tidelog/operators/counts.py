"""Daily counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import stage

# The actions of a commit's ops.
ACTIONS = ("create", "delete", "update")


def usable_events(parsed: DataFrame) -> DataFrame:
    """Rows that can be counted: the action must be there, the type may be null."""
    return parsed.where(F.col("action").isNotNull())


def counts_long(events: DataFrame) -> DataFrame:
    """``(type, action, n)``; a null type is a group of its own."""
    return usable_events(events).groupBy("type", "action").agg(F.count("*").alias("n"))


def distinct_actions(events: DataFrame) -> DataFrame:
    """``(action)`` in code-point order."""
    return usable_events(events).select("action").distinct().orderBy("action")


def column_names(actions: Sequence[str], taken: Sequence[str] = ("type",)) -> list[str]:
    """A column name for every action: its own, numbered where another column has
    the same name in any case."""
    seen, out = {t.lower() for t in taken}, []
    for action in actions:
        name, n = action, 1
        while name.lower() in seen:
            n += 1
            name = f"{action}_{n}"
        seen.add(name.lower())
        out.append(name)
    return out


class TooManyActions(Exception):
    """The events have more actions than the table may have columns."""


def actions_of(long: DataFrame, most: int) -> list[str]:
    """The actions that occur, in code-point order; an error if there are more than ``most``."""
    found = [r.action for r in long.select("action").distinct().orderBy("action").limit(most + 1).collect()]
    if len(found) > most:
        raise TooManyActions(f"more than {most} actions; name those wanted, the rest is counted together")
    return found


def _wide(n_of, actions: Sequence[str], other: str | None) -> list[Column]:
    names = column_names(actions, ("type", other) if other else ("type",))
    columns = [n_of(F.col("action") == a).alias(name) for a, name in zip(actions, names, strict=True)]
    return columns + ([n_of(~F.col("action").isin(list(actions))).alias(other)] if other else [])


def type_action_counts(long: DataFrame, actions: Sequence[str] | None = None, other: str = "other",
                       most: int = 200) -> DataFrame:
    """``counts_long`` turned wide: one row per type, one column per action, 0 when absent.

    By default a column for whatever action occurs, at most ``most``; the counts
    are staged, so events are read once.  With the caller's own ``actions`` the number of columns
    does not depend on the data, and column ``other`` counts all the rest.  No action is left out.
    """
    rest: str | None = other
    if actions is None:
        long = stage(long, "counts-long")
        actions, rest = actions_of(long, most), None
    if not actions and rest is None:
        return long.select("type").distinct()
    return long.groupBy("type").agg(*_wide(
        lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)), actions, rest))


def counts_for_actions(events: DataFrame, actions: Sequence[str], other: str = "other") -> DataFrame:
    """The same table in a form a stream accepts: one conditional count per action, and of the rest."""
    return usable_events(events).groupBy("type").agg(*_wide(F.count_if, actions, other))
