"""Servers and labelers named in the identity log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions import messages, records
from tidelog.sources import lines as L

# Text markers of label-related operations.
LABEL_MARKER = "label"
LABELER_MARKER = "atproto_labeler"


def label_operations(lines: DataFrame) -> DataFrame:
    return L.lines_with(lines, LABEL_MARKER)


def labeler_dids(lines: DataFrame, marker: str = LABELER_MARKER) -> DataFrame:
    """``(did)``: distinct accounts on lines that contain the marker.

    The substring test runs on the raw text; only the few lines that pass are
    parsed, and only for their ``did``.
    """
    hits = L.accepted(L.parse_lines(L.lines_with(lines, marker), "did string"))
    return hits.where("did <> ''").distinct()


def distinct_pds(operations: DataFrame) -> DataFrame:
    """``(pds)``: every server endpoint the log ever named."""
    pds = records.pds_endpoint(F.col("operation")).alias("pds")
    return operations.select(pds).where(F.col("pds").isNotNull()).distinct()


def explode_views(docs: DataFrame) -> DataFrame:
    """``(did, ord, handle, view)`` for every view that names its creator."""
    views = docs.select("did", "ord", F.explode("views").alias("view"))
    return (views.withColumn("handle", F.col("view.creator.handle"))
            .where("handle <> ''").select("did", "ord", "handle", "view"))


def handle_did_map(views: DataFrame, order: Column | None = None) -> DataFrame:
    """``(handle, did)``: the last writer of a handle by an explicit order."""
    order = F.col("ord") if order is None else order
    last = F.max(F.struct(order.alias("o"), F.col("did").alias("did")))
    return views.groupBy("handle").agg(last["did"].alias("did"))


def one_per_account(rows: DataFrame, value: str, order: Column | None = None) -> DataFrame:
    """The newest row of each account by ``order``; ties, and rows without an order,
    go to the larger value.  Accounts reduce before any join, so none is multiplied."""
    rank = F.lit(0) if order is None else order
    # A value that is there wins over none.
    last = F.max(F.struct(rank.alias("o"), F.col(value).alias("v")))
    return rows.groupBy("did").agg(last["v"].alias(value))


def labeler_endpoints(handles: DataFrame, did_docs: DataFrame,
                      wanted: str = "AtprotoLabeler", order: Column | None = None) -> DataFrame:
    """``(handle, did, service_endpoint)``: every handle once, endpoint or null.

    ``order`` tells which of several documents of an account is the newest.
    """
    listed = did_docs.select("did", records.first_service_of_type(F.col("service"), wanted).alias(
        "service_endpoint"), *([order.alias("_order")] if order is not None else []))
    found = one_per_account(listed, "service_endpoint", None if order is None else F.col("_order"))
    return handles.select("handle", "did").join(found, "did", "left").select(
        "handle", "did", "service_endpoint")


def pds_fallback(repos: DataFrame, errors: DataFrame, current: DataFrame, order: Column | None = None) -> DataFrame:
    """``(did, pds)``: the server to ask, the current one for accounts that moved.

    ``errors`` has ``(did, message)``, ``current`` has ``(did, current_pds)``, of several
    documents of an account the newest by ``order``.  A newest document that names no server
    leaves the account where it is listed.  Errors collapse to one flag, and
    documents to one server, per account before they are joined.
    """
    current = one_per_account(current, "current_pds", order)
    moved = (errors.where(messages.route_error(F.col("message")) == "moved")
             .select("did").distinct().withColumn("moved", F.lit(True)))
    asked = repos.join(moved, "did", "left").join(current, "did", "left")
    return asked.select("did", F.when(F.col("moved"), F.coalesce("current_pds", "pds"))
                        .otherwise(F.col("pds")).alias("pds"))


def parse_operations(lines: DataFrame) -> DataFrame:
    """Identity operations from raw lines; bad lines are left out."""
    return L.accepted(L.parse_lines(lines, schemas.PLC_OPERATION))
