"""Addresses, file-safe keys and what can be read back from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITE_SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
               "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column) -> Column:
    """Without white space on either side (``trim`` alone only takes blanks)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def collection(path: Column) -> Column:
    """The collection is the first segment of an op path."""
    return F.split_part(path, F.lit("/"), F.lit(1))


def event_uri(repo: Column, path: Column) -> Column:
    return F.concat(F.lit("at://"), repo, F.lit("/"), path)


def endpoint_key(endpoint: Column) -> Column:
    return F.translate(endpoint, "/:", "__")


def did_key(did: Column) -> Column:
    return F.translate(did, ":", "-")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def file_key(path: Column) -> Column:
    """``struct(did, kind)`` of ``<did>_<kind>.json``, null for other names.

    Half-written ``.json.tmp`` files do not count.
    """
    name = file_name(path)
    usable = name.endswith(".json") & name.contains("_")
    kind = F.split_part(F.split_part(name, F.lit("_"), F.lit(2)), F.lit("."), F.lit(1))
    return F.when(usable, F.struct(
        F.split_part(name, F.lit("_"), F.lit(1)).alias("did"), kind.alias("kind")))


def audit_key(path: Column) -> Column:
    """DID part of ``<did>_audit_log.json``, null for other names."""
    # Fixed value: the file-name suffix of an audit log.
    return F.nullif(F.regexp_extract(file_name(path), r"^(.*)_audit_log\.json$", 1), F.lit(""))


def date_from_path(path: Column) -> Column:
    """First ``YYYY-MM-DD`` in a path, empty when there is none."""
    return F.regexp_extract(path, r"\d{4}-\d{2}-\d{2}", 0)


def hash_bucket(key: Column, buckets: int | Column) -> Column:
    """Stable bucket of a key, independent of how the data is partitioned."""
    n = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), n)
