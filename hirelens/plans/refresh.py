"""Refreshing all serving tables from one reading of the postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.operators import analytics, rollups
from hirelens.operators.records import enrich
from hirelens.schema import SERVING
from hirelens.session import stored
from hirelens.sinks.serving import SnapshotTable

# What the rollups read; the raw text columns are not carried along.
NARROW = [
    "effective_city", "education", "company_type", "recruit_type", "skills", "avg_monthly_salary",
    "min_salary", "max_salary", "collection_count", "is_active", "is_internship",
    "is_high_collection", "negotiable", "intern_duration", "work_days_per_week", "has_conversion",
]

# serving table -> rollup it is cut from
_SINGLE_KEY = {
    "city_job_count": "city_job_count",
    "city_salary_stats": "city_salary_stats",
    "education_count": "education_count",
    "education_salary_stats": "education_salary_stats",
    "company_type_count": "company_type_count",
    "recruit_type_count": "recruit_type_count",
    "dashboard_summary": "dashboard_summary",
    "high_collection_jobs": "high_collection_salary",
    "active_jobs_stats": "active_jobs",
    "negotiable_ratio_stats": "negotiable_ratio",
    "activity_salary_comparison": "activity_salary",
}
_SKILL = ["skill_count", "skill_salary_stats", "skill_collection_rank"]


def narrow_jobs(postings: DataFrame) -> DataFrame:
    """The postings read and parsed once, into a narrow columnar table that several aggregates read."""
    return stored(enrich(postings).select(*NARROW), "jobs")


def tables_from(single: DataFrame, skills: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    """All fifteen serving tables, typed, cut from the sums of a reading or of many days."""
    tables = {name: rollups.from_all(single, rollup) for name, rollup in _SINGLE_KEY.items()}
    skills = rollups.skills_from(skills)
    tables.update({name: rollups.from_all_skills(skills, name) for name in _SKILL})
    terms = analytics.terms_from(terms, "effective_city")
    tables["internship_stats"] = terms.withColumnRenamed("effective_city", "city")
    return {name: contract.apply(tables[name]) for name, contract in SERVING.items()}


def serving_rollups(postings: DataFrame) -> dict[str, DataFrame]:
    """All fifteen serving tables, typed.

    The postings are read and parsed once; two aggregates and the internship terms read
    the narrow result, and the tables are cut from their small results.
    """
    jobs = narrow_jobs(postings)
    return tables_from(
        stored(rollups.all_rollups(jobs), "rollups"), stored(rollups.skill_sums(jobs), "skills"),
        analytics.term_sums(jobs, "effective_city"))


def serve(tables: dict[str, DataFrame], root: str, now: Column | None = None) -> dict[str, SnapshotTable]:
    """Upsert serving tables under ``root``, each in its ranking order."""
    now = F.current_timestamp() if now is None else now
    written = {}
    for name, df in tables.items():
        written[name] = SnapshotTable(df.sparkSession, f"{root}/{name}")
        written[name].upsert(df, [SERVING[name].key], now=now, ranked=SERVING[name].ranked)
    return written


def refresh(postings: DataFrame, root: str, now: Column | None = None) -> dict[str, SnapshotTable]:
    """Upsert all serving tables under ``root`` from one reading of the postings."""
    return serve(serving_rollups(postings), root, now)


def served_rows(written: dict[str, SnapshotTable]) -> DataFrame:
    """All measures of all tables as rows: table_name, key, measure, value."""
    rows = None
    for name, table in written.items():
        contract = SERVING[name]
        measures = [F.col(m).cast("double").alias(m) for m, _ in contract.measures]
        part = table.current().select(F.lit(name).alias("table_name"), F.col(contract.key).alias("key"), *measures)
        part = part.unpivot(["table_name", "key"], [m for m, _ in contract.measures], "measure", "value")
        rows = part if rows is None else rows.unionByName(part)
    return rows
