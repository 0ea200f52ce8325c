"""Listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.links import absolute_link, id_from_link

JOB_HREF = r"[^\"]*/jobs/detail/[0-9]+[^\"]*"


ANCHOR = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')"""
ENTITIES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def unescaped(value: Column) -> Column:
    for entity, char in ENTITIES.items():
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def page_links(
    pages: DataFrame, base_url: str, href_pattern: str = JOB_HREF, html: str = "html", *keep: str
) -> DataFrame:
    """Anchor targets of every page that match a pattern, in page order.

    Attribute names in either case, values in either quote, blanks around the sign and the
    entities of a link are read as a browser does; other attributes that end in href are not.
    One row per link: ``nth`` (0-based place among the matches), ``href``, the
    absolute ``link`` and the ``job_id`` it carries. Whole pages are searched.
    """
    values = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))
    hrefs = F.transform(values, lambda v: unescaped(F.substring(v, F.lit(2), F.length(v) - 2)))
    hrefs = F.filter(hrefs, lambda v: v.rlike(f"^(?:{href_pattern})$"))
    found = pages.select(*keep, F.posexplode(hrefs).alias("nth", "href"))
    return found.withColumn("link", absolute_link("href", base_url)).withColumn(
        "job_id", id_from_link("link")
    )
