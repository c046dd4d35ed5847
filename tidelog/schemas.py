"""Schemas of the landed data, as DDL."""

OPS = "array<struct<action string, path string, cid string>>"

# A decoded commit frame: `blocks` maps a content id to its record JSON.
COMMIT = f"seq bigint, kind string, repo string, time string, ops {OPS}, blocks map<string,string>"

# One event per op of a commit.
EVENT = (
    "seq bigint, collected_at timestamp, commit_time timestamp, commit_time_str string, "
    "action string, type string, uri string, author string, cid string, "
    "record variant, parse_error string, collect_date date"
)

# The part of an event line the daily counts need.
COUNTED = "type string, action string"

LABEL = "endpoint string, kind string, seq bigint, message string"

PLC_OPERATION = (
    "did string, createdAt string, "
    "operation struct<services: struct<atproto_pds: struct<endpoint: string>>, service: string>"
)

SERVICES = "array<struct<type string, serviceEndpoint string>>"
VIEWS = "array<struct<creator struct<handle string>>>"
ENDPOINT_CSV = "handle string, did string, service_endpoint string"
