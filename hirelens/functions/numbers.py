"""Whole-number arithmetic: averages are truncated and percentages rounded half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(a: Column, b: Column) -> Column:
    """Integer division (null when the divisor is null)."""
    return F.call_function("div", a, b)


def percent(part: Column, total: Column) -> Column:
    """100 * part / total, rounded half up to two decimals, without binary error."""
    hundredths = whole_div(part * 20000 + total, total * 2)
    return F.when(total > 0, hundredths / 100).otherwise(F.lit(0.0))


def percent_text(part: Column, total: Column) -> Column:
    """The same percentage as text with two decimals."""
    return F.format_string("%.2f", percent(part, total))
