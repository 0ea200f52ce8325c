"""Derived columns of a posting, as the rollups read it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions import description, salary, text, title


def enrich(postings: DataFrame) -> DataFrame:
    """Add every derived column; unused ones are pruned by the optimizer.

    All are native expressions, so a rollup over two of them evaluates just these
    two, inside the scan stage.
    """
    return postings.withColumns(
        {
            "effective_city": title.effective_city("city", "job_name"),
            "min_salary": salary.min_yuan("salary"),
            "max_salary": salary.max_yuan("salary"),
            "salary_months": salary.months_paid("salary"),
            "negotiable": salary.is_negotiable("salary"),
            "collection_count": description.favourites("job_desc"),
            "activity_label": description.activity_label("job_desc"),
            "is_active": description.is_active("job_desc"),
            "is_internship": title.is_internship("recruit_type", "job_name"),
            "skills": text.split_tags("skill_tags"),
        }
    ).withColumns(
        {
            "avg_monthly_salary": salary.midpoint("min_salary", "max_salary"),
            "is_high_collection": F.col("collection_count") >= V.ROLLUP_FAVOURITES_FROM,
        }
    ).withColumn("annual_salary", salary.annual("avg_monthly_salary", "salary_months"))


def explode_skills(enriched: DataFrame) -> DataFrame:
    """One row per skill of a posting."""
    return enriched.withColumn("skill", F.explode("skills")).drop("skills")
