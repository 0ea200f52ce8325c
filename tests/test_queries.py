"""Every registered query against its SQL, and against figures worked out beforehand."""

import pytest
from conftest import SF, SF_GATE

import __spark_entry__ as entry_points
import oracle
from hirelens.plans.catalogue import QUERIES
from hirelens.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 8


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert oracle.differences(df, con, ORACLES[name]) == []


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF_GATE).collect()]


def test_known_figures(spark):
    dash = {r["metric_name"]: r["metric_value"] for r in rows(spark, "dashboard_summary")}
    assert dash == {"total_jobs": "15000", "avg_salary": "17494", "valid_salary_jobs": "11846"}
    city = {r["city"]: r for r in rows(spark, "city_salary_stats")}["上海"]
    assert (city["avg_salary"], city["min_salary"], city["max_salary"], city["job_count"]) == (
        17510, 5000, 33000, 1792,
    )
    intern = {r["city"]: r for r in rows(spark, "internship_stats")}["上海"]
    assert (intern["internship_count"], intern["avg_salary"]) == (755, 13292)
    liked = {r["city"]: r for r in rows(spark, "high_collection")}["上海"]
    assert (liked["high_collection_count"], liked["total_collection"]) == (592, 49792)
    active = {r["city"]: r for r in rows(spark, "active_jobs")}["上海"]
    assert (active["active_count"], active["avg_salary"]) == (865, 13727)
    open_pay = {r["city"]: r for r in rows(spark, "negotiable_ratio")}["北京"]
    assert (open_pay["total_count"], open_pay["negotiable_count"], open_pay["negotiable_ratio"]) == (
        3117, 500, 16.04,
    )
    kinds = {r["activity_type"]: (r["job_count"], r["avg_salary"]) for r in rows(spark, "activity_salary")}
    assert kinds == {"活跃": (4516, 17173), "非活跃": (7330, 17692)}
    skills = {r["skill"]: r["count"] for r in rows(spark, "skill_count")}
    assert skills == {"Java": 6000, "SQL": 6000, "Go": 3000, "Python": 3000, "Redis": 3000, "Spark": 3000}
    java = {r["skill"]: r for r in rows(spark, "skill_salary_stats")}["Java"]
    assert (java["avg_salary"], java["min_salary"], java["max_salary"], java["job_count"]) == (
        16994, 5000, 32000, 4738,
    )
    doctor = {r["education"]: r for r in rows(spark, "education_salary_stats")}["博士"]
    assert (doctor["avg_salary"], doctor["min_salary"], doctor["max_salary"], doctor["job_count"]) == (
        17494, 7000, 31000, 2370,
    )
    liked_java = {r["skill"]: r for r in rows(spark, "skill_collection_rank")}["Java"]
    assert (liked_java["total_collection"], liked_java["job_count"]) == (132888, 1582)
    top = rows(spark, "top10_cities")
    assert {"北京": 3117, "杭州": 2359}.items() <= {r["city"]: r["job_count"] for r in top}.items()
    assert [r["job_count"] for r in top] == sorted((r["job_count"] for r in top), reverse=True)
    assert len(rows(spark, "cleaned_postings")) == 13531
