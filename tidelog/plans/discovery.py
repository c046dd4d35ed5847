"""Labelers: from the identity log to the endpoints to read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelog.operators import endpoints, identity


def labelers(operation_lines: DataFrame) -> DataFrame:
    """``(did)``: accounts whose operations name a labeler."""
    return identity.labeler_dids(identity.label_operations(operation_lines))


def endpoints_to_read(views: DataFrame, did_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(endpoint, seq)``: label services and the position to continue from."""
    handles = identity.handle_did_map(identity.explode_views(views))
    table = identity.labeler_endpoints(handles, did_docs)
    clean = endpoints.clean_endpoints(table)
    return endpoints.resume_seq_by_endpoint(clean, labels)
