"""Schemaless records: variants, overlays, binary values, dropped fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_field(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "string")


def overlay(record: Column, name: str, envelope: Column) -> Column:
    """Value of ``name`` after merging the record over the envelope.

    A key the record carries wins, also when its value is null.
    """
    carried = F.try_variant_get(record, f"$.{name}", "variant").isNotNull()
    return F.when(carried, record_field(record, name)).otherwise(envelope.cast("string"))


def base64_line(value: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(value), r"[\r\n]", "")


def drop_fields(value: Column, *names: str) -> Column:
    """A struct without the named fields."""
    return value.dropFields(*names)


def drop_fields_each(values: Column, *names: str) -> Column:
    """An array of structs, each without the named fields."""
    return F.transform(values, lambda v: v.dropFields(*names))


def drop_keys(json: Column, *names: str) -> Column:
    """A JSON object without the named top-level keys, schema not needed."""
    fields = F.from_json(json, "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*names)),
                     {"ignoreNullFields": "false"})


def first_service_of_type(services: Column, wanted: str = "AtprotoLabeler") -> Column:
    """Endpoint of the first service of the type; null when it has none."""
    return F.get(F.filter(services, lambda s: s["type"] == wanted), 0)["serviceEndpoint"]


def pds_endpoint(operation: Column) -> Column:
    """New-style server endpoint, else the legacy one; empty counts as missing."""
    return F.coalesce(
        F.nullif(operation["services"]["atproto_pds"]["endpoint"], F.lit("")),
        F.nullif(operation["service"], F.lit("")))


def ascii_json(json: Column) -> Column:
    """JSON text with non-ASCII characters as escapes.

    The writer option only escapes Spark strings, not text inside a variant.  So
    the whole text is written as a JSON string once more, which escapes it, and
    the quotes and backslashes that this doubles are taken back.
    """
    quoted = F.to_json(F.struct(json.alias("v")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    inner = F.regexp_replace(quoted, r'^\{"v":"|"\}$', "")
    escaped = F.regexp_replace(inner, r'\\(["\\])', "$1")
    return F.when(F.octet_length(json) != F.length(json), escaped).otherwise(json)
