"""Field repair: what replaces a missing or wrong value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.text import blank_to_null, col, is_listed, text_of


def is_company_tag(company: Column | str) -> Column:
    """Not a company name: a known label or shorter than two characters (F16)."""
    return is_listed(col(company), V.COMPANY_TAGS) | (F.length(col(company)) < 2)


def repaired_company(company: Column | str, candidate: Column | str) -> Column:
    """F17."""
    fixed = F.coalesce(col(candidate), F.lit(V.UNKNOWN))
    return F.when(is_company_tag(company), fixed).otherwise(col(company))


def repaired_city(city: Column | str, from_title: Column | str, from_text: Column | str) -> Column:
    """Given city, else the title's, else the description's."""
    return F.coalesce(blank_to_null(city), col(from_title), col(from_text), F.lit(""))


def repaired_degree(degree: Column | str, candidate: Column | str) -> Column:
    """A blank or open requirement yields to the description's."""
    is_open = col(degree).isin("", V.ANY_DEGREE)
    return F.when(is_open, F.coalesce(col(candidate), col(degree))).otherwise(col(degree))


def repaired_job_type(job_type: Column | str, candidate: Column | str) -> Column:
    """F20."""
    return F.coalesce(blank_to_null(job_type), col(candidate), F.lit(""))


def value_tags(favourites: Column | str, active_status: Column | str, hr_tag: bool = False) -> Column:
    """Value labels of a cleaned row.

    ``hr_tag`` adds the separate label for HR marks that the cleaning plan asks for (R23).
    """
    status = text_of(active_status)
    tags = [
        F.when(col(favourites) >= V.CLEAN_FAVOURITES_FROM, F.lit(V.TAG_FAVOURITE)),
        F.when(status != "", F.lit(V.TAG_ACTIVE)),
    ]
    if hr_tag:
        hr = status.contains(V.HR_MARKS[0]) | status.contains(V.HR_MARKS[1])
        tags.append(F.when(hr, F.lit(V.TAG_HR_ACTIVE)))
    return F.array_compact(F.array(*tags))


def content_key(company: Column | str, title: Column | str, city: Column | str) -> Column:
    """``company_title_city``; the plain join, delimiter collisions included."""
    return F.concat_ws("_", col(company), col(title), col(city))


def visible_company(c: Column | str) -> Column:
    """Company name without invisible characters, with a cut-off suffix completed."""
    # fixed values: zero-width characters, byte order mark, soft hyphen
    shown = F.regexp_replace(text_of(c), r"[\x{200b}-\x{200f}\x{2060}\x{feff}\x{ad}]", "")
    shown = F.trim(shown)
    return F.when(shown.endswith("有限"), F.concat(shown, F.lit("公司"))).otherwise(shown)
