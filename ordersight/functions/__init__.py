"""Column expressions shared by the operators."""

from ordersight.functions.coerce import strip_lower, to_day, to_money, to_number, to_whole
from ordersight.functions.numbers import percent, ratio, round_to, whole_percent

__all__ = [
    "percent",
    "ratio",
    "round_to",
    "strip_lower",
    "to_day",
    "to_money",
    "to_number",
    "to_whole",
    "whole_percent",
]
