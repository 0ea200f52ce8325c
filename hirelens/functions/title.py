"""Rules that read the job title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.text import capture, col, first_group, is_listed, strip, text_of


def clean_title(c: Column | str) -> Column:
    """Stripped title; blank or placeholder becomes unknown."""
    title = strip(c)
    bad = (title == "") | title.contains(V.PLACEHOLDER_TITLE)
    return F.when(bad, F.lit(V.UNKNOWN)).otherwise(title)


def is_valid_title(title: Column | str) -> Column:
    """F21, on a cleaned title."""
    return col(title) != V.UNKNOWN


def city_in_title(title: Column | str) -> Column:
    """Text of the first bracket if it is 2-5 characters and not a code."""
    inner = capture(col(title), V.RE_TITLE_BRACKET)
    ok = F.length(inner).between(2, 5) & ~inner.rlike("^[a-zA-Z0-9]")
    return F.when(ok, inner)


def batch_in_title(title: Column | str) -> Column:
    """Graduation batch such as ``25届``."""
    return F.concat(capture(col(title), V.RE_TITLE_BATCH), F.lit(V.BATCH_SUFFIX))


def effective_city(city: Column | str, title: Column | str) -> Column:
    """City, else a listed city in brackets of the title, else unknown."""
    given = text_of(city)
    inner = F.regexp_extract(text_of(title), V.RE_TITLE_CITY, 1)
    return (
        F.when(given != "", given)
        .when(is_listed(inner, V.TITLE_CITIES), inner)
        .otherwise(F.lit(V.UNKNOWN))
    )


def is_internship(recruit_type: Column | str, title: Column | str) -> Column:
    """F26."""
    return (text_of(recruit_type) == V.INTERNSHIP) | text_of(title).contains(V.INTERNSHIP)


def standard_title(c: Column | str) -> Column:
    """Title without city brackets, batch marks and job code."""
    title = clean_title(c)
    # fixed values: bracketed batches, bare batches, bracketed short Chinese places, trailing city
    title = F.regexp_replace(title, r"[\[【](?:20)?[0-9]{2}届?(?:校招|秋招)?[\]】]", "")
    title = F.regexp_replace(title, r"[（(](?:20)?[0-9]{2}届?(?:校招|秋招)?[）)]", "")
    title = F.regexp_replace(title, r"(?:20)?[0-9]{2}届(?:校招|秋招)?", "")
    title = F.regexp_replace(title, r"[（(][一-龥]{2,5}[）)]", "")
    title = F.regexp_replace(title, V.RE_JOB_CODE, "")
    cities = "|".join(V.DESC_CITIES)
    title = F.regexp_replace(title, f"-(?:{cities})$", "")
    title = F.regexp_replace(title, r"-{2,}", "-")
    return F.btrim(title, F.lit("- "))


def job_code(c: Column | str) -> Column:
    """Posting number in a title, e.g. ``J15117``; null when there is none."""
    return capture(text_of(c), V.RE_JOB_CODE, 0)


def pay_in_title(c: Column | str) -> Column:
    """A pay range left in the title, written as in the pay field."""
    tidy = F.translate(text_of(c), "k～~ ", "K--")
    found = F.regexp_extract(tidy, r"([0-9]+)K?-([0-9]+)K", 1)
    upper = F.regexp_extract(tidy, r"([0-9]+)K?-([0-9]+)K", 2)
    return F.when(found != "", F.concat(found, F.lit("-"), upper, F.lit("K")))


def city_after_dash(c: Column | str) -> Column:
    """A listed city after the last dash of a title, null when there is none."""
    return capture(strip(c), f"-({'|'.join(V.DESC_CITIES)})$")


def job_category(c: Column | str) -> Column:
    """Normalised category of a title: its job family, else unknown."""
    return F.coalesce(first_group(standard_title(c), V.JOB_FAMILIES), F.lit(V.UNKNOWN))


def is_well_formed_id(job_id: Column | str) -> Column:
    """An id is a whole number."""
    return strip(job_id).rlike("^[0-9]+$")


def is_meaningful(title: Column | str, job_id: Column | str) -> Column:
    """Row has a usable title and an id."""
    return is_valid_title(clean_title(title)) & (strip(job_id) != "")


__all__ = [
    "batch_in_title", "city_after_dash", "city_in_title", "clean_title", "effective_city",
    "is_internship", "is_meaningful", "is_valid_title", "is_well_formed_id", "job_category",
    "job_code", "pay_in_title", "standard_title",
]
