"""Time columns. Nothing here reads the clock: callers pass ``now``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sensorloom.constants import MICROS

# --- fixed value: the shape of an RFC 3339 instant ---
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"
# --- end of fixed value ---


def micros(seconds: float) -> int:
    """A duration in seconds as whole microseconds, the unit of all event-time arithmetic."""
    return round(seconds * MICROS)


def parse_rfc3339(text: Column, fallback: Column) -> Column:
    """RFC 3339 text to TIMESTAMP; ``fallback`` when it is anything else.

    Spark's own cast also accepts bare dates and years, hence the shape test first.
    """
    shaped = F.when(text.rlike(RFC3339), F.translate(text, ",", "."))
    return F.coalesce(F.try_to_timestamp(shaped), fallback)


def rfc3339_seconds(ts: Column) -> Column:
    """Whole-second RFC 3339 text in UTC (the session time zone)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def clock_text(ts: Column) -> Column:
    """``HH:mm:ss`` text of a window bound."""
    return F.date_format(ts, "HH:mm:ss")


def bucket_start(value: Column, width: int) -> Column:
    """Start of the zero-aligned bucket of a LONG (floor, also below zero)."""
    return value - F.pmod(value, F.lit(width))


def bucket_number(value: Column, width: int) -> Column:
    """Number of the zero-aligned bucket of a LONG, in integer arithmetic."""
    return F.call_function("div", bucket_start(value, width), F.lit(width))
