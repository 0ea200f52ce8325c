"""Link rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.text import capture, col, text_of


def absolute_link(href: Column | str, base_url: str) -> Column:
    """Complete a relative link (F32); null stays null."""
    h = col(href)
    return (
        F.when(h.startswith("/"), F.concat(F.lit(base_url), h))
        .when(h.startswith("http"), h)
        .otherwise(F.concat(F.lit(base_url + "/"), h))
    )


def id_from_link(link: Column | str) -> Column:
    """Trailing number of a link, else the number of a detail page, else blank."""
    text = text_of(link)
    return F.coalesce(
        capture(text, V.RE_TRAILING_ID), capture(text, V.RE_DETAIL_ID), F.lit("")
    )


def recruit_type_from_url(url: Column | str) -> Column:
    """Recruit type of a listing page."""
    text = text_of(url)
    picked = None
    for part, name in V.RECRUIT_BY_URL:
        hit = text.contains(part)
        picked = F.when(hit, F.lit(name)) if picked is None else picked.when(hit, F.lit(name))
    return picked.otherwise(F.lit(V.UNKNOWN))
