"""Event-time expressions, all at millisecond precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis(ts: Column) -> Column:
    """Timestamp cut to milliseconds; also turns a zone-less timestamp into an instant."""
    return F.date_trunc("MILLISECOND", ts)


def iso(ts: Column) -> Column:
    """``2026-01-01T10:00:00Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def gap_millis(a: Column, b: Column) -> Column:
    return F.abs(F.unix_millis(a) - F.unix_millis(b))
