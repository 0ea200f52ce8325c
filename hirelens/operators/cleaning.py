"""Cleaning: repair fields, derive columns, drop repeated ids, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions import description as D
from hirelens.functions import repair as R
from hirelens.functions import salary as S
from hirelens.functions import title as T
from hirelens.functions.text import strip, text_of
from hirelens.operators.dedup import first_wins, row_key
from hirelens.schema import COLUMNS

PROVENANCE = ["company_from", "city_from", "degree_from", "job_type_from"]


def repair_fields(raw: DataFrame, hr_tag: bool = False) -> DataFrame:
    """Row-wise part of the cleaning: no exchange, native expressions only.

    Adds the derived columns, the content key and, per repaired field, where its
    value came from.
    """
    kept = [c for c in raw.columns if c not in COLUMNS]
    base = raw.withColumns(
        {
            "_title": T.clean_title("job_name"),
            "_company": strip("company_name"),
            "_city": strip("city"),
            "_degree": strip("education"),
            "_type": strip("job_type"),
            "_desc": strip("job_desc"),
        }
    )
    found = base.withColumns(
        {
            "_city_t": T.city_in_title("_title"),
            "_city_d": D.city_in_text("_desc"),
            "_degree_d": D.degree_in_text("_desc"),
            "_type_d": D.family_in_text("_desc"),
            "_company_d": D.company_in_text("_desc"),
            "collection_count": D.favourites("_desc"),
            "active_status": D.activity_marks("_desc"),
        }
    )
    is_tag = R.is_company_tag("_company")
    fixed = found.withColumns(
        {
            "company_name": R.repaired_company("_company", "_company_d"),
            "company_from": F.when(~is_tag, "given")
            .when(F.col("_company_d").isNotNull(), "desc")
            .otherwise("unknown"),
            "city": R.repaired_city("_city", "_city_t", "_city_d"),
            "city_from": F.when(F.col("_city") != "", "given")
            .when(F.col("_city_t").isNotNull(), "title")
            .when(F.col("_city_d").isNotNull(), "desc")
            .otherwise("none"),
            "education": R.repaired_degree("_degree", "_degree_d"),
            "degree_from": F.when(
                F.col("_degree").isin("", V.ANY_DEGREE) & F.col("_degree_d").isNotNull(), "desc"
            ).otherwise("given"),
            "job_type": R.repaired_job_type("_type", "_type_d"),
            "job_type_from": F.when(
                (F.col("_type") == "") & F.col("_type_d").isNotNull(), "desc"
            ).otherwise("given"),
            "job_name": F.col("_title"),
            "is_valid_job": T.is_valid_title("_title"),
            "parsed_salary": S.salary_struct(strip("salary")),
            "batch": F.coalesce(T.batch_in_title("_title"), text_of("graduate_year")),
            "value_tags": R.value_tags("collection_count", "active_status", hr_tag),
        }
    ).withColumn("content_key", R.content_key("company_name", "job_name", "city"))
    present = [c for c in COLUMNS if c in raw.columns]
    derived = ["is_valid_job", "parsed_salary", "collection_count", "active_status", "batch",
               "value_tags", "content_key"]
    return fixed.select(*present, *derived, *PROVENANCE, *kept)


def clean_postings(raw: DataFrame, order: list[str], hr_tag: bool = False) -> DataFrame:
    """The cleaned table: first row per id, repaired and with derived columns.

    Ids are deduplicated before fields are extracted, so repeated rows cost no
    extraction and the exchange carries raw columns only.
    """
    cleaned = repair_fields(first_wins(raw, order), hr_tag)
    return cleaned.drop("content_key", *PROVENANCE)


def high_value_test() -> Column:
    return F.size("value_tags") > 0


def high_value(cleaned: DataFrame) -> DataFrame:
    """Rows with a value tag."""
    return cleaned.where(high_value_test())


def meaningful(cleaned: DataFrame) -> DataFrame:
    """Rows with a usable title and an id."""
    return cleaned.where(F.col("is_valid_job") & (strip("job_id") != ""))


def well_formed(cleaned: DataFrame) -> DataFrame:
    """Meaningful rows whose id is a whole number."""
    return meaningful(cleaned).where(T.is_well_formed_id("job_id"))


def fill_from_text(df: DataFrame) -> DataFrame:
    """Blank cities from a trailing dash of the title, blank pay from the description, and the job category."""
    city, pay = strip("city"), strip("salary")
    return df.withColumns(
        {
            "city": F.when(city != "", city).otherwise(F.coalesce(T.city_after_dash("job_name"), F.lit(""))),
            "salary": F.when(pay != "", pay).otherwise(F.coalesce(D.pay_in_text("job_desc"), F.lit(""))),
            "job_category": T.job_category("job_name"),
        }
    )


def normalise_titles(df: DataFrame) -> DataFrame:
    """Standard title, job code, repaired company text and pay moved out of the title."""
    return df.withColumns(
        {
            "standard_title": T.standard_title("job_name"),
            "job_code": T.job_code("job_name"),
            "company_name": R.visible_company("company_name"),
            "salary": F.coalesce(F.nullif(strip("salary"), F.lit("")), T.pay_in_title("job_name"), F.lit("")),
        }
    )


def content_duplicates(repaired: DataFrame) -> DataFrame:
    """How many rows repeat an earlier content key (A17). One row."""
    return repaired.agg(
        (F.count(F.lit(1)) - F.count_distinct("content_key")).alias("duplicate_content_warning")
    )


def first_rows(raw: DataFrame, order: list[str]) -> DataFrame:
    """The first row of every id, as first-wins keeps it, with the number of its rows as ``_rows``."""
    first = raw.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(row_key(order))]).agg(
        F.min_by(F.struct(*raw.columns), F.struct(*order)).alias("_row"), F.count(F.lit(1)).alias("_rows")
    )
    return first.select("_row.*", "_rows")


def repair_counters() -> dict[str, Column]:
    """Counters over the repaired :func:`first_rows`; all but the repeated contents can also be observed."""

    def came(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value)

    rows_in, rows_out = F.coalesce(F.sum("_rows"), F.lit(0)), F.count(F.lit(1))
    return {
        "input_count": rows_in,
        "total_processed": rows_in,
        "output_count": rows_out,
        "high_value_count": F.count_if(high_value_test()),
        "company_restored_from_desc": came("company_from", "desc"),
        "company_unknown": came("company_from", "unknown"),
        "city_restored_from_title": came("city_from", "title"),
        "city_restored_from_desc": came("city_from", "desc"),
        "degree_restored_from_desc": came("degree_from", "desc"),
        "type_restored_from_desc": came("job_type_from", "desc"),
        "duplicate_id": rows_in - rows_out,
    }


# Counters that are reported at zero, too.
ALWAYS_TOLD = ["input_count", "output_count", "high_value_count"]


def cleaning_report(raw: DataFrame, order: list[str]) -> DataFrame:
    """Counters of a cleaning run as (metric, value) rows.

    The three row counts are always present; a named counter that stays at zero is not.
    One reading: the aggregate that keeps the first row of an id also counts its rows.
    """
    kept = repair_fields(first_rows(raw, order))
    repeated = F.count(F.lit(1)) - F.count_distinct("content_key")
    counters = {**repair_counters(), "duplicate_content_warning": repeated}
    totals = kept.agg(*[agg.alias(name) for name, agg in counters.items()])
    long = totals.unpivot([], list(counters), "metric", "value")
    return long.where(F.col("metric").isin(ALWAYS_TOLD) | (F.col("value") > 0))
