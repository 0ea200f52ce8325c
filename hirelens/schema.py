"""Posting schema, source key names and serving table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: source key -> column
SOURCE_KEYS = {
    "岗位名称": "job_name",
    "公司名称": "company_name",
    "薪资": "salary",
    "学历要求": "education",
    "城市": "city",
    "职位类型": "job_type",
    "招聘人数": "recruit_count",
    "公司类型": "company_type",
    "公司性质": "company_nature",
    "毕业年份": "graduate_year",
    "每周工作天数": "work_days_per_week",
    "实习时长": "intern_duration",
    "是否有转正": "has_conversion",
    "职位描述": "job_desc",
    "职位链接": "job_link",
    "job_id": "job_id",
    "技能要求标签": "skill_tags",
    "福利标签": "benefit_tags",
    "careerJob": "career_job",
    "招聘类型": "recruit_type",
}

COLUMNS = list(SOURCE_KEYS.values())

# The 18 columns of the flat export, in order.
EXPORT_COLUMNS = [c for c in COLUMNS if c not in ("skill_tags", "benefit_tags")]


def _type_of(column: str) -> T.DataType:
    return T.IntegerType() if column == "career_job" else T.StringType()


# What arrives, under its source keys, and what we work with.
SOURCE_POSTING = T.StructType([T.StructField(k, _type_of(c)) for k, c in SOURCE_KEYS.items()])
POSTING = T.StructType([T.StructField(c, _type_of(c)) for c in COLUMNS])


def from_source_keys(df: DataFrame) -> DataFrame:
    """Rename source keys to columns, leaving other columns alone."""
    return df.withColumnsRenamed(SOURCE_KEYS)


def to_source_keys(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: k for k, c in SOURCE_KEYS.items()})


@dataclass(frozen=True)
class Serving:
    """One serving table: key, measures with types, and the measure it is ranked by."""

    key: str
    measures: tuple[tuple[str, str], ...]
    ranked_by: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        """Project a rollup to the contract: names, order and types."""
        return df.select(
            F.col(self.key).cast("string").alias(self.key),
            *[F.col(name).cast(kind).alias(name) for name, kind in self.measures],
        )

    def ranked(self, df: DataFrame) -> DataFrame:
        """Rows in the order the table is served in."""
        if self.ranked_by is None:
            return df.orderBy(self.key)
        return df.orderBy(F.desc(self.ranked_by), self.key)


# Counts and sums are bigint: a 32-bit column would overflow on a large input.
_MONEY = "decimal(18,2)"
_SALARY = (("avg_salary", _MONEY), ("min_salary", "bigint"), ("max_salary", "bigint"))
_JOBS = (("job_count", "bigint"),)
_COUNT = (("count", "bigint"),)

# fixed values: the fifteen serving tables
SERVING = {
    "city_job_count": Serving("city", _JOBS, "job_count"),
    "city_salary_stats": Serving("city", _SALARY + _JOBS, "avg_salary"),
    "skill_count": Serving("skill", _COUNT, "count"),
    "skill_salary_stats": Serving("skill", _SALARY + _JOBS, "avg_salary"),
    "education_count": Serving("education", _COUNT),
    "education_salary_stats": Serving("education", _SALARY + _JOBS),
    "company_type_count": Serving("company_type", _COUNT, "count"),
    "recruit_type_count": Serving("recruit_type", _COUNT),
    "internship_stats": Serving(
        "city",
        (("internship_count", "bigint"), ("avg_duration", "string"), ("conversion_rate", "decimal(5,2)")),
    ),
    "dashboard_summary": Serving("metric_name", (("metric_value", "string"),)),
    "high_collection_jobs": Serving(
        "city",
        (("high_collection_count", "bigint"), ("avg_salary", _MONEY), ("total_collection", "bigint")),
        "high_collection_count",
    ),
    "active_jobs_stats": Serving(
        "city", (("active_count", "bigint"), ("avg_salary", _MONEY)), "active_count"
    ),
    "negotiable_ratio_stats": Serving(
        "city",
        (("total_count", "bigint"), ("negotiable_count", "bigint"), ("negotiable_ratio", "decimal(5,2)")),
    ),
    "skill_collection_rank": Serving(
        "skill", (("total_collection", "bigint"), ("job_count", "bigint")), "total_collection"
    ),
    "activity_salary_comparison": Serving("activity_type", _JOBS + _SALARY),
}
