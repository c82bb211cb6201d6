"""Turning raw text into typed values; what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_lower(text: Column) -> Column:
    """Drop white space of any kind at both ends, then lower-case."""
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def to_day(text: Column) -> Column:
    return text.try_cast("timestamp_ntz").cast("date")


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def to_whole(text: Column) -> Column:
    """An INT, also from texts like ``1.0``."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.try_cast("int"))


def to_money(text: Column) -> Column:
    """DECIMAL(10,2); a number that does not fit fails with its text instead of being lost."""
    number, exact = to_number(text), text.try_cast("decimal(38,2)")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    too_large = finite & (exact.isNull() | (F.abs(exact) >= 10**8))
    failure = F.raise_error(F.concat(F.lit("amount does not fit DECIMAL(10,2): "), text))
    return F.when(too_large, failure).otherwise(exact).cast("decimal(10,2)")
