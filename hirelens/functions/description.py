"""Rules that read the free-text description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.text import capture, capture_number, col, first_group, first_listed, text_of


def favourites(c: Column | str) -> Column:
    """Favourite count, 0 when not stated.

    The substring test is much cheaper than the regex and is false for most rows.
    """
    text = text_of(c)
    marked = F.when(text.contains(V.FAVOURITES_MARK), text)
    return F.coalesce(capture_number(marked, V.RE_FAVOURITES), F.lit(0).cast("bigint"))


def activity_marks(c: Column | str) -> Column:
    """All activity marks in fixed order, ``|``-joined, blank when none."""
    text = text_of(c)
    return F.concat_ws("|", *[F.when(text.contains(m), F.lit(m)) for m in V.ACTIVITY_MARKS])


def activity_label(c: Column | str) -> Column:
    """First of the two labels the rollups know, else blank (F8)."""
    return F.coalesce(first_listed(text_of(c), V.ACTIVE_LABELS), F.lit(""))


def is_active(c: Column | str) -> Column:
    return activity_label(c) != ""


def city_in_text(c: Column | str) -> Column:
    return first_listed(col(c), V.DESC_CITIES)


def degree_in_text(c: Column | str) -> Column:
    return first_listed(col(c), V.DEGREES)


def family_in_text(c: Column | str) -> Column:
    return first_group(col(c), V.JOB_FAMILIES)


def company_in_text(c: Column | str) -> Column:
    return first_listed(col(c), V.KNOWN_COMPANIES)


def pay_in_text(c: Column | str) -> Column:
    """A pay range stated in a description, as in the pay field; null when there is none."""
    return capture(text_of(c), V.RE_PAY_IN_TEXT, 0)


# fixed values: names of boards; a site's own index board is added by the caller
BOARDS = ["HC充足榜", "学历友好榜", "校招高薪榜", "高校必争榜"]


def signals(c: Column | str, boards: list[str] = BOARDS) -> Column:
    """Other marks mixed into descriptions, as an array of ``kind:value``."""
    text = text_of(c)

    def found(kind: str, pattern: str, group: int) -> Column:
        value = F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
        return F.concat(F.lit(kind + ":"), value)

    def named(kind: str, words: list[str]) -> list[Column]:
        return [F.when(text.contains(w), F.lit(f"{kind}:{w}")) for w in words]

    # fixed values: patterns and names of the signals
    return F.array_compact(
        F.array(
            found("pay_percentile", r"薪资超([0-9]+)%同类职位", 1),
            found("deadline_days", r"还有([0-9]+)天截止", 1),
            *named("board", boards),
            *named("apply", ["简历直投官网", "专属内推通道"]),
        )
    )
