"""Record headers: an array of (key, value bytes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultflow.schemas import HEADER_CORRELATION, HEADER_EVENT_TYPE, HEADER_SOURCE


def header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))


def stamp(correlation: Column, source: Column, event_type: Column) -> Column:
    """The three headers every published event carries."""
    return F.array(
        header(HEADER_CORRELATION, correlation),
        header(HEADER_SOURCE, source),
        header(HEADER_EVENT_TYPE, event_type),
    )


def last_value(headers: Column, name: str) -> Column:
    """Bytes of the last header of that name, null if there is none."""
    return F.get(F.reverse(F.filter(headers, lambda h: h["key"] == name)), F.lit(0))["value"]


def last_text(headers: Column, name: str) -> Column:
    return F.decode(last_value(headers, name), "UTF-8")


def propagate(headers: Column) -> Column:
    """What an outcome record inherits from its request: correlation id, then source."""

    def keep(name: str) -> Column:
        value = last_value(headers, name)
        return F.when(value.isNotNull(), F.struct(F.lit(name).alias("key"), value.alias("value")))

    return F.array_compact(F.array(keep(HEADER_CORRELATION), keep(HEADER_SOURCE)))
