"""Amount and transaction-type expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultflow.schemas import CREDIT_TYPES

# A decimal number as JSON or a decimal literal writes it.
NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def is_credit(type_: Column) -> Column:
    return type_.isin(*CREDIT_TYPES)


def signed_amount(type_: Column, amount: Column) -> Column:
    return F.when(is_credit(type_), amount).otherwise(-amount)


def _mantissa(raw: Column) -> Column:
    return F.substring_index(F.lower(raw), "e", 1)


def written_scale(raw: Column) -> Column:
    """Decimal places of a number as written: ``1.100`` has 3, ``1.10E+3`` has -1."""
    mantissa = _mantissa(raw)
    point = F.instr(mantissa, ".")
    places = F.when(point > 0, F.length(mantissa) - point).otherwise(0)
    exponent = F.when(F.length(raw) > F.length(mantissa), F.substring_index(F.lower(raw), "e", -1).try_cast("int"))
    return places - F.coalesce(exponent, F.lit(0))


def written_positive(raw: Column) -> Column:
    """Whether a written number is above zero, whatever its size."""
    return ~raw.startswith("-") & (F.translate(_mantissa(raw), "0.", "") != "")


def parse_amount(raw: Column) -> Column:
    """Amount with two decimals; null if it does not fit, so check the written scale first."""
    return raw.try_cast("decimal(38,10)").try_cast("decimal(28,2)")


def cents(amount: Column) -> Column:
    """Whole cents; an amount beyond 64 bits fails the job instead of wrapping."""
    return (amount.cast("decimal(38,2)") * 100).cast("bigint")


def from_cents(value: Column) -> Column:
    return (value * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def text(value: Column) -> Column:
    """A value in a message; a missing one prints as ``null``."""
    return F.coalesce(value.cast("string"), F.lit("null"))
