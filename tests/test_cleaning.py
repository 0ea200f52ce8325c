"""Deduplication, cleaning, report and rollup properties."""

import pytest
from conftest import SF, SF_GATE
from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.operators import analytics as A
from hirelens.operators import cleaning, dedup, quality, ranking, rollups
from hirelens.operators.records import enrich
from hirelens.plans import views
from hirelens.plans.catalogue import QUERIES
from hirelens.plans.refresh import refresh
from hirelens.schema import SERVING


@pytest.fixture(scope="module")
def raw(spark):
    return views.postings(spark, SF).cache()


@pytest.fixture(scope="module")
def jobs(raw):
    return enrich(raw).cache()


def same(a, b):
    key = lambda r: str(r)
    return sorted(map(tuple, a.select(*sorted(a.columns)).collect()), key=key) == sorted(
        map(tuple, b.select(*sorted(b.columns)).collect()), key=key
    )


def test_first_wins_keeps_blanks(spark):
    rows = [(i, v) for i, v in enumerate(["1", "1", "", "", "2", " 1 ", None])]
    df = spark.createDataFrame(rows, "ord bigint, job_id string")
    got = dedup.first_wins(df, ["ord"]).orderBy("ord").collect()
    assert [r.ord for r in got] == [0, 2, 3, 4, 6]


def test_first_wins_limits_a_hot_key_before_the_exchange(spark):
    df = spark.range(0, 30000, 1, 6).selectExpr(
        "id AS ord", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS job_id"
    )
    kept = dedup.first_wins(df, ["ord"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning", final) < partial
    assert kept.count() == 20001


@pytest.mark.parametrize("name", [
    "dedup_first_wins", "cleaned_postings", "cleaning_report", "union_recruit_types", "job_counters", "quality_change",
])
def test_one_reading(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1


def test_hot_and_blank_ids(spark):
    df = spark.range(0, 3000, 1, 6).selectExpr(
        "id AS ord", "CASE id % 10 WHEN 0 THEN 'hot' WHEN 1 THEN 'hot' WHEN 2 THEN 'hot' WHEN 3 THEN ' ' "
        "WHEN 4 THEN NULL WHEN 5 THEN '' ELSE CAST(id AS STRING) END AS job_id"
    )
    kept = dedup.first_wins(df, ["ord"])
    assert kept.count() == 1 + 900 + 1200 and kept.agg(F.min("ord")).first()[0] == 0
    merged = dedup.merge_by_recruit_type(df.withColumn("recruit_type", F.expr("if(ord % 2 = 0, 'b', 'a')")),
                                         {"a": "x", "b": "y"}, ["ord"])
    assert merged.count() == kept.count()
    assert merged.where("job_id = 'hot'").select("ord", "recruit_type").collect() == [(1, "x")]


def test_empty_report(raw):
    got = {r.metric: r.value for r in cleaning.cleaning_report(raw.limit(0), ["ord"]).collect()}
    assert got == {"input_count": 0, "output_count": 0, "high_value_count": 0}


def test_dedup_is_idempotent_and_ignores_row_order(raw):
    once = dedup.first_wins(raw, ["ord"])
    assert same(dedup.first_wins(once, ["ord"]).select("ord"), once.select("ord"))
    assert same(dedup.first_wins(raw.repartition(7, "salary"), ["ord"]).select("ord"), once.select("ord"))


def test_earlier_listing_wins(spark):
    a = spark.createDataFrame([(5, "1", "x"), (6, "", "x")], "ord bigint, job_id string, a string")
    b = spark.createDataFrame([(1, "1", "y"), (2, "2", "y"), (3, "", "y")], "ord bigint, job_id string, b string")
    got = dedup.merge_recruit_types([a, b], ["ord"]).orderBy("ord").collect()
    assert [(r.ord, r.job_id, r.a, r.b) for r in got] == [
        (2, "2", None, "y"), (3, "", None, "y"), (5, "1", "x", None), (6, "", "x", None),
    ]


def test_cleaning_twice_keeps_repaired_fields(raw):
    fields = ["ord", "job_name", "company_name", "city", "education", "job_type", "batch"]
    once = cleaning.clean_postings(raw, ["ord"])
    twice = cleaning.clean_postings(once.select(*raw.columns), ["ord"])
    assert same(once.select(*fields), twice.select(*fields))


def test_report_adds_up(raw):
    got = {r.metric: r.value for r in cleaning.cleaning_report(raw, ["ord"]).collect()}
    assert got["input_count"] - got["duplicate_id"] == got["output_count"] == 1353
    cleaned = cleaning.clean_postings(raw, ["ord"])
    assert cleaning.high_value(cleaned).count() == got["high_value_count"]


def test_zero_counters_are_absent(spark, raw):
    one = raw.where("ord = 1")
    got = {r.metric: r.value for r in cleaning.cleaning_report(one, ["ord"]).collect()}
    assert "duplicate_id" not in got and "duplicate_content_warning" not in got and got["input_count"] == 1


def test_rollups_of_halves_add_up(jobs):
    left, right = jobs.where("ord < 700"), jobs.where("ord >= 700")
    both = rollups.city_job_count(left).unionByName(rollups.city_job_count(right))
    total = both.groupBy("city").agg(F.sum("job_count").alias("job_count"))
    assert same(total, rollups.city_job_count(jobs))
    assert same(rollups.city_salary_stats(jobs.repartition(5)), rollups.city_salary_stats(jobs))


@pytest.mark.parametrize("name", [
    "city_job_count", "city_salary_stats", "skill_count", "skill_salary_stats", "education_count",
    "education_salary_stats", "company_type_count", "recruit_type_count", "internship_stats",
    "dashboard_summary", "high_collection", "active_jobs", "negotiable_ratio",
    "skill_collection_rank", "activity_salary",
])
def test_empty_input_gives_no_rows(jobs, name):
    assert getattr(rollups, name)(jobs.limit(0)).count() == 0


@pytest.mark.parametrize("name", [
    "city_job_count", "city_salary_stats", "education_count", "education_salary_stats",
    "company_type_count", "recruit_type_count", "internship_stats", "dashboard_summary",
    "high_collection_salary", "active_jobs", "negotiable_ratio", "activity_salary",
])
def test_one_pass_equals_separate_rollups(jobs, name):
    wide = rollups.all_rollups(jobs).cache()
    assert same(rollups.from_all(wide, name), getattr(rollups, name)(jobs))


def test_rollups_use_partial_aggregates_and_no_python(jobs, spark):
    fresh = views.jobs(spark, SF_GATE)  # not the cached one
    for build in (rollups.city_salary_stats, rollups.skill_salary_stats, rollups.all_rollups):
        plan = build(fresh)._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan and "EvalPython" not in plan
    narrow = rollups.education_count(fresh)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in narrow and "c_name" not in narrow and "o_totalprice" not in narrow


def test_ranks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, n bigint")
    got = {r.k: r["rank"] for r in ranking.ranked(df, "n").collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 4}


def test_quantiles_of_small_groups(spark):
    df = spark.createDataFrame([("a", 1000), ("a", 2000), ("b", 7000), ("c", None)], "k string, v bigint")
    got = {r.k: tuple(r)[1:] for r in A.quantiles_by(df, ["k"], "v", (50, 90)).collect()}
    assert got == {"a": (2, 1500.0, 1900.0), "b": (1, 7000.0, 7000.0)}


def test_running_totals_over_many_ranges(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE 'k' || id % 2 END AS k", "id AS v", "id % 5 + 1 AS n"
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.running_totals(df, ["k"], F.desc("v"), "n").cache()
        assert got.count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    group = Window.partitionBy("k")
    down = group.orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumns({"_upto": F.sum("n").over(down), "_total": F.sum("n").over(group)})
    assert same(got, expected)


def test_profile_counts_blanks_nulls_and_empty_arrays(spark):
    df = spark.createDataFrame([("a", [1]), ("", []), (None, None)], "s string, a array<int>")
    got = {r.field: (r.filled, r.total, r.rate) for r in quality.profile(df).collect()}
    assert got == {"s": (1, 3, 33.33), "a": (1, 3, 33.33)}


def test_sample_does_not_depend_on_partitions(raw):
    a = quality.review_sample(raw.repartition(3), "ord", 20).select("ord")
    assert same(a, quality.review_sample(raw.coalesce(1), "ord", 20).select("ord"))


def test_filters(jobs):
    got = A.matching(jobs, cities=["北京"], skills=["Go"])
    assert got.where("effective_city <> '北京' OR NOT array_contains(skills, 'Go')").count() == 0
    assert got.count() == jobs.where("effective_city = '北京' AND array_contains(skills, 'Go')").count() > 0
    assert A.matching(jobs).count() == jobs.count()


def test_one_skill_pass_equals_separate_rollups(jobs):
    wide = rollups.all_skill_rollups(jobs).cache()
    for name in ("skill_count", "skill_salary_stats", "skill_collection_rank"):
        assert same(rollups.from_all_skills(wide, name), getattr(rollups, name)(jobs))


def test_refresh_writes_fifteen_tables(spark, raw, jobs, tmp_path):
    written = refresh(raw, str(tmp_path), now=F.lit("t0"))
    assert set(written) == set(SERVING) and len(written) == 15
    cities = written["city_job_count"].current()
    assert same(cities.select("city", "job_count"), rollups.city_job_count(jobs))
    refresh(raw.where("city = '北京'"), str(tmp_path), now=F.lit("t1"))
    again = {r.city: r for r in written["city_job_count"].current().collect()}
    assert len(again) == cities.count() and again["北京"].update_time == "t1"
    assert again["上海"].update_time == "t0"
