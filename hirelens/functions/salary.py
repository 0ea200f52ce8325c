"""Pay strings. Two readings exist and both are kept (cleaning: K, rollups: yuan)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.numbers import whole_div
from hirelens.functions.text import capture, capture_number, col, let, text_of


def salary_struct(c: Column | str) -> Column:
    """struct<min,max,months,negotiable,raw> in thousands; null for a blank string (F2).

    Spaces are dropped and ``k`` is read as ``K`` first; a month count is only
    read right after the range (``15-25K·14薪``).
    """
    text = text_of(c)
    raw = F.translate(text, "k ", "K")
    negotiable = raw.contains(V.NEGOTIABLE)
    stated = F.when(~negotiable, raw)
    span = F.coalesce(capture(stated, V.RE_PAY_WITH_MONTHS, 0), capture(stated, V.RE_PAY, 0))

    def parts(found: Column) -> Column:
        """Fields of a matched ``15-25K·14薪``; all null when nothing matched."""
        low = F.substring_index(found, "-", 1)
        high = F.substring_index(F.substring_index(found, "-", -1), "K", 1)
        months = F.btrim(F.substring_index(found, "K", -1), F.lit("·.薪"))
        default = F.lit(V.DEFAULT_MONTHS).cast("bigint")
        return F.struct(
            low.try_cast("bigint").alias("min"),
            high.try_cast("bigint").alias("max"),
            F.when(
                found.isNotNull(), F.coalesce(F.nullif(months, F.lit("")).try_cast("bigint"), default)
            ).alias("months"),
            negotiable.alias("negotiable"),
            raw.alias("raw"),
        )

    return F.when(text != "", let(span, parts))


def is_negotiable(c: Column | str) -> Column:
    """Blank or marked as open to talks."""
    text = text_of(c)
    return (text == "") | text.contains(V.NEGOTIABLE)


def _stated(c: Column | str) -> Column:
    """The pay string, null when it is negotiable.

    The condition is applied to the input of the patterns, not to their result: inside
    a conditional branch Spark would run a pattern twice, for the match test and for
    the value.
    """
    return F.when(~is_negotiable(c), text_of(c))


def min_yuan(c: Column | str) -> Column:
    return capture_number(_stated(c), V.RE_PAY_ANY_CASE, 1) * 1000


def max_yuan(c: Column | str) -> Column:
    return capture_number(_stated(c), V.RE_PAY_ANY_CASE, 2) * 1000


def months_paid(c: Column | str) -> Column:
    """Months per year, wherever stated, else 12 - also when no range is readable."""
    default = F.when(~is_negotiable(c), F.lit(V.DEFAULT_MONTHS).cast("bigint"))
    return F.coalesce(capture_number(_stated(c), V.RE_MONTHS), default)


def midpoint(low: Column | str, high: Column | str) -> Column:
    """Whole-number middle of a range, null unless both ends are known."""
    return whole_div(col(low) + col(high), F.lit(2))


def annual(mid: Column | str, months: Column | str) -> Column:
    """Yearly pay."""
    return col(mid) * col(months)
