"""Rounding and ratios that give the same digits on any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Half-up rounding through DECIMAL, so binary noise cannot flip a digit."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double; NULL when the divisor is zero or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    return round_to(ratio(top.cast("double") * F.lit(100.0), bottom), digits)


def whole_percent(top: Column, bottom: Column) -> Column:
    """``top * 100 / bottom`` in whole numbers, cut towards zero, as a double."""
    scaled = top.cast("bigint") * F.lit(100).cast("bigint")
    divisor = F.nullif(bottom.cast("bigint"), F.lit(0).cast("bigint"))
    return F.call_function("div", scaled, divisor).cast("double")
