"""Group-by statistics.

The generic operators take any DataFrame and column names. All aggregates are
algebraic, so each rollup is scan -> partial aggregate -> one exchange of at
most (tasks x groups) small rows -> final aggregate, whatever share of the rows
one key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.numbers import percent, whole_div
from hirelens.operators.records import explode_skills

MID = "avg_monthly_salary"


# --- generic -----------------------------------------------------------------


def count_by(df: DataFrame, *keys: str, name: str = "job_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def not_blank(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all non-blank."""
    for key in keys:
        df = df.where(F.col(key) != "")
    return df


def salary_aggs(mid: str = MID, low: str = "min_salary", high: str = "max_salary") -> list[Column]:
    """Truncated mean over salaried rows, lowest, highest and salaried count."""
    return [
        whole_div(F.sum(mid), F.count(mid)).alias("avg_salary"),
        F.min(low).alias("min_salary"),
        F.max(high).alias("max_salary"),
        F.count(mid).alias("job_count"),
    ]


def salary_stats_by(
    df: DataFrame, *keys: str, mid: str = MID, low: str = "min_salary", high: str = "max_salary"
) -> DataFrame:
    """Salary statistics of the rows that state a salary.

    Rows without one are skipped by the aggregates and groups without any are dropped
    at the end: as a filter, the condition would be pushed below the projection and
    parse every pay string twice.
    """
    return df.groupBy(*keys).agg(*salary_aggs(mid, low, high)).where("job_count > 0")


def zero_filled_avg_by(df: DataFrame, *keys: str, count_name: str, mid: str = MID) -> DataFrame:
    """Row count, and mean over *all* rows with a missing salary counted as 0."""
    total = F.coalesce(F.sum(mid), F.lit(0).cast("bigint"))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name),
        whole_div(total, F.count(F.lit(1))).alias("avg_salary"),
    )


def ratio_by(
    df: DataFrame, flag: str, *keys: str, total_name: str, part_name: str, ratio_name: str
) -> DataFrame:
    """Rows, flagged rows and their percentage to two decimals."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(total_name),
            F.count_if(F.col(flag)).alias(part_name),
        )
        .withColumn(ratio_name, percent(F.col(part_name), F.col(total_name)))
    )


# --- the fifteen job rollups, over enriched postings --------------------------


def city_job_count(jobs: DataFrame) -> DataFrame:
    """A1."""
    return count_by(jobs.select(F.col("effective_city").alias("city")), "city")


def city_salary_stats(jobs: DataFrame) -> DataFrame:
    """A2."""
    return salary_stats_by(jobs, "effective_city").withColumnRenamed("effective_city", "city")


def skill_count(jobs: DataFrame) -> DataFrame:
    """A3."""
    return count_by(explode_skills(jobs.select("skills")), "skill", name="count")


def skill_salary_stats(jobs: DataFrame) -> DataFrame:
    """A4."""
    slim = jobs.select("skills", MID, "min_salary", "max_salary")
    return salary_stats_by(explode_skills(slim), "skill")


def education_count(jobs: DataFrame) -> DataFrame:
    """A5."""
    return count_by(not_blank(jobs, "education"), "education", name="count")


def education_salary_stats(jobs: DataFrame) -> DataFrame:
    """A6."""
    return salary_stats_by(not_blank(jobs, "education"), "education")


def company_type_count(jobs: DataFrame) -> DataFrame:
    """A7."""
    return count_by(not_blank(jobs, "company_type"), "company_type", name="count")


def recruit_type_count(jobs: DataFrame) -> DataFrame:
    """A8."""
    return count_by(not_blank(jobs, "recruit_type"), "recruit_type", name="count")


def internship_stats(jobs: DataFrame) -> DataFrame:
    """The mean divides by all internships."""
    interns = jobs.where("is_internship")
    return zero_filled_avg_by(
        interns, "effective_city", count_name="internship_count"
    ).withColumnRenamed("effective_city", "city")


def dashboard_summary(jobs: DataFrame) -> DataFrame:
    """A10: three name/value rows, none on empty input (hence the constant group)."""
    totals = jobs.groupBy(F.lit("ALL").alias("scope")).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.coalesce(whole_div(F.sum(MID), F.count(MID)), F.lit(0)).alias("avg_salary"),
        F.count(MID).alias("valid_salary_jobs"),
    )
    names = ["total_jobs", "avg_salary", "valid_salary_jobs"]
    return totals.select(*[F.col(n).cast("string") for n in names]).unpivot(
        [], names, "metric_name", "metric_value"
    )


def high_collection_salary(jobs: DataFrame) -> DataFrame:
    """A11 with the mean salary its serving table has a column for."""
    return (
        jobs.where("is_high_collection")
        .groupBy(F.col("effective_city").alias("city"))
        .agg(
            F.count(F.lit(1)).alias("high_collection_count"),
            F.sum("collection_count").alias("total_collection"),
            whole_div(F.sum(MID), F.count(MID)).alias("avg_salary"),
        )
    )


def high_collection(jobs: DataFrame) -> DataFrame:
    """A11."""
    return high_collection_salary(jobs).drop("avg_salary")


def active_jobs(jobs: DataFrame) -> DataFrame:
    """The mean divides by all active rows."""
    return zero_filled_avg_by(
        jobs.where("is_active"), "effective_city", count_name="active_count"
    ).withColumnRenamed("effective_city", "city")


def negotiable_ratio(jobs: DataFrame, key: str = "effective_city", name: str = "city") -> DataFrame:
    """A13, and R20 with another key."""
    return ratio_by(
        jobs.select(F.col(key).alias(name), "negotiable"),
        "negotiable",
        name,
        total_name="total_count",
        part_name="negotiable_count",
        ratio_name="negotiable_ratio",
    )


def skill_collection_rank(jobs: DataFrame) -> DataFrame:
    """A14."""
    liked = jobs.where("is_high_collection").select("skills", "collection_count")
    return explode_skills(liked).groupBy("skill").agg(
        F.sum("collection_count").alias("total_collection"),
        F.count(F.lit(1)).alias("job_count"),
    )


def activity_salary(jobs: DataFrame) -> DataFrame:
    """A15."""
    kind = F.when(F.col("is_active"), F.lit(V.ACTIVITY_YES)).otherwise(F.lit(V.ACTIVITY_NO))
    return salary_stats_by(jobs.withColumn("activity_type", kind), "activity_type")


def job_counters(records: DataFrame) -> DataFrame:
    """Lines in, rows parsed, corrupt rows and high-collection matches, as name/value rows.

    ``records`` are enriched rows of :func:`hirelens.sources.lines.parse_lines` with ``keep_all``.
    """
    return records.agg(
        F.count(F.lit(1)).alias("lines_in"),
        F.count_if(F.col("is_record") & F.col("corrupt_line").isNull()).alias("records_out"),
        F.count("corrupt_line").alias("parse_errors"),
        F.count_if(F.col("is_high_collection")).alias("matched_jobs"),
    ).unpivot([], ["lines_in", "records_out", "parse_errors", "matched_jobs"], "counter", "value")


# --- one pass for every single-key rollup --------------------------------------

DIMENSIONS = ["effective_city", "education", "company_type", "recruit_type", "activity_type"]


def all_rollups(jobs: DataFrame) -> DataFrame:
    """Every single-key measure of every dimension from ONE scan and ONE exchange.

    Fifteen separate jobs scan and parse the postings fifteen times; this long
    table (``dimension, value`` + all measures; ``ALL`` holds the totals) replaces
    thirteen of them, and :func:`from_all` cuts a rollup out of it. Skills need an
    explode and stay separate.
    """
    kind = F.when(F.col("is_active"), F.lit(V.ACTIVITY_YES)).otherwise(F.lit(V.ACTIVITY_NO))
    narrow = jobs.withColumn("activity_type", kind).select(
        *DIMENSIONS, MID, "min_salary", "max_salary", "collection_count",
        "is_internship", "is_active", "is_high_collection", "negotiable",
    )
    zero = F.lit(0).cast("bigint")

    def total_where(flag: str, value: str) -> Column:
        return F.sum(F.when(F.col(flag), F.coalesce(F.col(value), zero)))

    sets = [[F.col(d)] for d in DIMENSIONS] + [[]]
    wide = narrow.groupingSets(sets, *[F.col(d) for d in DIMENSIONS]).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("job_count"),
        F.count(MID).alias("salaried_count"),
        F.sum(MID).alias("salary_total"),
        F.min("min_salary").alias("min_salary"),
        F.max("max_salary").alias("max_salary"),
        F.count_if("is_internship").alias("internship_count"),
        total_where("is_internship", MID).alias("internship_salary_total"),
        F.count_if("is_active").alias("active_count"),
        total_where("is_active", MID).alias("active_salary_total"),
        F.count_if("is_high_collection").alias("high_collection_count"),
        total_where("is_high_collection", "collection_count").alias("total_collection"),
        F.count(F.when(F.col("is_high_collection"), F.col(MID))).alias("high_salaried_count"),
        F.sum(F.when(F.col("is_high_collection"), F.col(MID))).alias("high_salary_total"),
        F.count_if("negotiable").alias("negotiable_count"),
    )
    # grouping_id has a bit per dimension, first dimension highest, set = grouped away.
    full = (1 << len(DIMENSIONS)) - 1
    dimension, value = F.lit("ALL"), F.lit("ALL")
    for i, name in enumerate(DIMENSIONS):
        here = F.col("level") == (full ^ (1 << (len(DIMENSIONS) - 1 - i)))
        dimension = F.when(here, F.lit(name)).otherwise(dimension)
        value = F.when(here, F.col(name)).otherwise(value)
    return wide.select(
        dimension.alias("dimension"),
        value.alias("value"),
        *[c for c in wide.columns if c not in DIMENSIONS and c != "level"],
    )


def from_all(rollup: DataFrame, table: str) -> DataFrame:
    """One serving rollup out of the result of :func:`all_rollups`."""

    def of(dimension: str, name: str) -> DataFrame:
        return rollup.where(F.col("dimension") == dimension).withColumnRenamed("value", name)

    def salaries(dimension: str, name: str) -> DataFrame:
        return of(dimension, name).where("salaried_count > 0").select(
            name,
            whole_div(F.col("salary_total"), F.col("salaried_count")).alias("avg_salary"),
            "min_salary",
            "max_salary",
            F.col("salaried_count").alias("job_count"),
        )

    def counts(dimension: str) -> DataFrame:
        return of(dimension, dimension).where(F.col(dimension) != "").select(
            dimension, F.col("job_count").alias("count")
        )

    city = of("effective_city", "city")
    if table == "city_job_count":
        return city.select("city", "job_count")
    if table == "city_salary_stats":
        return salaries("effective_city", "city")
    if table in ("education_count", "company_type_count", "recruit_type_count"):
        return counts(table.removesuffix("_count"))
    if table == "education_salary_stats":
        return salaries("education", "education").where("education <> ''")
    if table == "activity_salary":
        return salaries("activity_type", "activity_type")
    if table == "internship_stats":
        mean = whole_div(F.col("internship_salary_total"), F.col("internship_count"))
        return city.where("internship_count > 0").select(
            "city", "internship_count", mean.alias("avg_salary")
        )
    if table == "active_jobs":
        mean = whole_div(F.col("active_salary_total"), F.col("active_count"))
        return city.where("active_count > 0").select("city", "active_count", mean.alias("avg_salary"))
    if table == "high_collection_salary":
        mean = whole_div(F.col("high_salary_total"), F.nullif(F.col("high_salaried_count"), F.lit(0)))
        return city.where("high_collection_count > 0").select(
            "city", "high_collection_count", "total_collection", mean.alias("avg_salary")
        )
    if table == "negotiable_ratio":
        ratio = percent(F.col("negotiable_count"), F.col("job_count"))
        return city.select(
            "city",
            F.col("job_count").alias("total_count"),
            "negotiable_count",
            ratio.alias("negotiable_ratio"),
        )
    if table == "dashboard_summary":
        mean = F.coalesce(whole_div(F.col("salary_total"), F.nullif(F.col("salaried_count"), F.lit(0))), F.lit(0))
        names = ["total_jobs", "avg_salary", "valid_salary_jobs"]
        return of("ALL", "scope").where("job_count > 0").select(
            F.col("job_count").cast("string").alias("total_jobs"),
            mean.cast("string").alias("avg_salary"),
            F.col("salaried_count").cast("string").alias("valid_salary_jobs"),
        ).unpivot([], names, "metric_name", "metric_value")
    raise ValueError(f"{table} is not a single-key rollup")


def skill_sums(jobs: DataFrame) -> DataFrame:
    """What the three skill rollups (A3, A4, A14) are made of, from one scan and one exchange; days add up."""
    liked = F.when(F.col("is_high_collection"), F.col("collection_count"))
    slim = jobs.select(
        "skills", MID, "min_salary", "max_salary", liked.alias("high_collection")
    )
    return explode_skills(slim).groupBy("skill").agg(
        F.count(F.lit(1)).alias("count"),
        F.count(MID).alias("salaried_count"),
        F.sum(MID).alias("salary_total"),
        F.min("min_salary").alias("min_salary"),
        F.max("max_salary").alias("max_salary"),
        F.sum("high_collection").alias("total_collection"),
        F.count("high_collection").alias("high_count"),
    )


def skills_from(sums: DataFrame) -> DataFrame:
    mean = whole_div(F.col("salary_total"), F.nullif(F.col("salaried_count"), F.lit(0)))
    return sums.select(
        "skill", "count", mean.alias("avg_salary"), "min_salary", "max_salary",
        F.col("salaried_count").alias("job_count"), "total_collection", "high_count",
    )


def all_skill_rollups(jobs: DataFrame) -> DataFrame:
    """The measures of the three skill rollups (A3, A4, A14) from one scan and one exchange."""
    return skills_from(skill_sums(jobs))


def merged_sums(parts: DataFrame, *keys: str) -> DataFrame:
    """Partial results of several days as one: lowest and highest of ``min_`` and ``max_`` columns, sums of the others."""

    def merge(name: str) -> Column:
        fold = F.min if name.startswith("min_") else F.max if name.startswith("max_") else F.sum
        return fold(name).alias(name)

    return parts.groupBy(*keys).agg(*[merge(c) for c in parts.columns if c not in keys])


def from_all_skills(rollup: DataFrame, table: str) -> DataFrame:
    """One skill rollup out of the result of :func:`all_skill_rollups`."""
    if table == "skill_count":
        return rollup.select("skill", "count")
    if table == "skill_salary_stats":
        stats = ["avg_salary", "min_salary", "max_salary", "job_count"]
        return rollup.where("job_count > 0").select("skill", *stats)
    if table == "skill_collection_rank":
        return rollup.where("high_count > 0").select(
            "skill", "total_collection", F.col("high_count").alias("job_count")
        )
    raise ValueError(f"{table} is not a skill rollup")
