"""Error texts and process-event lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker text -> class, first match wins.
REPO_ERRORS = (("InvalidRequest", "moved"), ("RateLimitExceeded", "rate_limited"))
PROFILE_ERRORS = (("Profile not found", "not_found"), ("3000", "rate_limited"))

# Token patterns and the size limit of process events.
LENGTH_TOKEN = r"len:([0-9]+)"
EVENT_TOKEN = r"eventname:(\S+)"
FIRST_TOKEN = r"^\s*(\S+)"
PROCESS_TOKEN = r"processname:([^\s,]+)"
FROM_STATE_TOKEN = r"from_state:([^\s,]+)"
STATE_PREFIX = "PROCESS_STATE_"
MAX_PAYLOAD = 1_048_576


def route_error(message: Column, rules=REPO_ERRORS) -> Column:
    """Class of an error text; null when there is no error."""
    routed = F.when(message.isNull(), F.lit(None).cast("string"))
    for marker, name in rules:
        routed = routed.when(message.contains(marker), F.lit(name))
    return routed.otherwise(F.lit("other"))


def _token(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def event_name(header: Column) -> Column:
    return F.coalesce(_token(header, EVENT_TOKEN), _token(header, FIRST_TOKEN))


def payload_length(header: Column) -> Column:
    return _token(header, LENGTH_TOKEN).try_cast("bigint")


def process_name(payload: Column) -> Column:
    return F.coalesce(_token(payload, PROCESS_TOKEN), F.lit("unknown"))


def from_state(payload: Column) -> Column:
    return F.coalesce(_token(payload, FROM_STATE_TOKEN), F.lit("unknown"))


def to_state(header: Column) -> Column:
    return F.regexp_replace(event_name(header), f"^{STATE_PREFIX}", "")
