"""Event times, UTC days and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the wire format of commit and operation times.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Fixed value: the shape of a day argument.
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def parse_event_time(text: Column) -> Column:
    """UTC timestamp; null unless the text has 1-6 fraction digits and a ``Z``."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def format_event_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def collect_date(collected_at: Column) -> Column:
    """UTC day of collection (the session runs in UTC)."""
    return F.to_date(collected_at)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def valid_date(text: Column, real: bool = False) -> Column:
    """Shape test of a day argument; ``real`` also asks for a calendar day."""
    shaped = F.coalesce(text.rlike(DATE_SHAPE), F.lit(False))
    if not real:
        return shaped
    return shaped & F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.floor(F.unix_micros(ts) / F.lit(1_000_000)).cast("bigint")
