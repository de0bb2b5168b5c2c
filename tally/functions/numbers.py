"""Locale numbers: parsing and printing with decimal comma and grouping point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that counts as a plain number in a key/value table (fixed value).
PLAIN_NUMBER = r"^[0-9]*\.*[0-9]+$"


def parse_de_number(text: Column, to: str = "double") -> Column:
    """``1.234,5`` -> 1234.5; text that is no number, or no whole number for a whole type, becomes null."""
    plain = F.translate(F.trim(text), ",.", ".")
    if to not in ("tinyint", "smallint", "int", "bigint", "long", "integer"):
        return plain.try_cast(to)
    exact = plain.try_cast("decimal(38,9)")  # ``1.234,0`` is a whole number too
    return F.when(exact == F.floor(exact), exact.try_cast(to))


def format_de(value: Column, digits: int = 1) -> Column:
    """1234567.25 -> ``1.234.567,2`` (round half even on the exact value)."""
    return F.translate(F.format_number(value, digits), ".,", ",.")


def format_signed_de(value: Column, digits: int = 1) -> Column:
    """Like :func:`format_de`, always with a sign: ``+10,1``, ``-3,0``, ``+0,0``."""
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, format_de(F.abs(value), digits))


def zero_pad(value: Column, width: int) -> Column:
    """7 -> ``007``; longer numbers are kept whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def numeric_or_null(text: Column) -> Column:
    """The number a plain numeric text stands for, else null."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def sentinel_to_null(text: Column, contains: str | None = None, equals: str | None = None) -> Column:
    """Null out cells that hold a marker: containing ``contains`` or equal to ``equals``."""
    marker = F.lit(False)
    if contains is not None:
        marker = marker | text.contains(contains)
    if equals is not None:
        marker = marker | (text == F.lit(equals))
    return F.when(~F.coalesce(marker, F.lit(False)), text)
