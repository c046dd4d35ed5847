"""Service endpoint normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.keys import strip


def normalize_endpoint(text: Column) -> Column:
    """``authority + path`` of an endpoint; null when empty or not a URL.

    White space around it and slashes after it go; a missing scheme counts as
    https; scheme, path parameters, query and fragment are dropped; a port and
    user info stay.
    """
    bare = F.nullif(F.rtrim(strip(text), F.lit("/")), F.lit(""))
    url = F.when(bare.contains("://"), bare).otherwise(F.concat(F.lit("https://"), bare))
    path = F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), r";[^/]*$", "")
    return F.concat(F.try_parse_url(url, F.lit("AUTHORITY")), path)


def valid_endpoint(endpoint: Column) -> Column:
    """Not missing, not empty, not on the local machine."""
    return F.coalesce(
        (endpoint != "") & ~endpoint.startswith("localhost"), F.lit(False))
