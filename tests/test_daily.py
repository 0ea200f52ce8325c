"""Refresh by landed day, sketches, and the cleaning run as one job."""

import gzip

import pytest
from conftest import SF
from pyspark.sql import functions as F

from hirelens.operators import analytics as A
from hirelens.operators import cleaning
from hirelens.plans import cleaning_run, daily, views
from hirelens.plans.catalogue import DAYS, _land_by_day
from hirelens.plans.cleaning_run import run_cleaning
from hirelens.plans.refresh import refresh, serving_rollups
from hirelens.schema import SERVING
from hirelens.sources import lines


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing") / "jobs")
    _land_by_day(views.postings(spark, SF).where("ord % 97 <> 3"), root)
    return root


def test_days_add_up_and_are_replaced(spark, landed, tmp_path):
    state, serving = str(tmp_path / "parts"), str(tmp_path / "serving")
    args = (spark, landed, state, serving)
    daily.refresh_days(*args, [DAYS[1]], now=F.lit("t0"))
    written = daily.refresh_days(*args, [DAYS[0], DAYS[1], DAYS[2]], now=F.lit("t1"))  # one day comes again, counted once
    whole = serving_rollups(views.postings(spark, SF).where("ord % 97 <> 3"))
    for name in ("city_salary_stats", "skill_salary_stats", "internship_stats", "dashboard_summary"):
        assert rows(written[name].current().drop("update_time")) == rows(whole[name])


def test_a_day_reads_its_directory_alone(spark, landed):
    df = daily.landed_postings(spark, landed, DAYS[2])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"= {DAYS[2]})]" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_line_is_parsed_once(spark, landed):
    plan = daily.landed_postings(spark, landed, DAYS[2]).select("job_name")
    told = plan._jdf.queryExecution().optimizedPlan().toString()
    assert told.count("from_json(") == 1 and told.count("trim(") == 1


def test_a_comma_at_the_end_is_dropped(spark):
    ends = [" a,\t", "a,b", "a,,", ",", "a,\u2028", None, "[", ""]
    lines_ = spark.createDataFrame([(e,) for e in ends], "value string")
    got = [r.value for r in lines.record_lines(lines_).collect()]
    assert got == ["a", "a,b", "a,", "", "a\u2028"]


def test_served_order_after_a_second_refresh(spark, tmp_path):
    postings = views.postings(spark, SF)
    refresh(postings.where("ord % 2 = 0"), str(tmp_path), now=F.lit("t0"))
    written = refresh(postings, str(tmp_path), now=F.lit("t1"))
    for name, table in written.items():
        contract = SERVING[name]
        got = [(r[contract.ranked_by] if contract.ranked_by else 0, r[contract.key]) for r in table.current().collect()]
        assert got == sorted(got, key=lambda x: (-x[0], x[1]))


def test_serving_rollups_are_typed(spark):
    for name, df in serving_rollups(views.postings(spark, SF)).items():
        assert df.dtypes[1:] == [(m, k) for m, k in SERVING[name].measures]


def test_merged_sketches_keep_their_rank_error(spark):
    """A hundred sketches of 1,000 values, merged: ranks are off by less than 1 %."""
    values = spark.range(100_000).select(
        (F.col("id") % 100).alias("day"), F.lit("x").alias("city"), F.pmod(F.col("id") * 7919, F.lit(100_000)).alias("pay"))
    merged = A.merged_sketches(A.sketch_by(values, "day", "city", value="pay"), "city")
    got = A.sketched_quantiles(merged, "city", percents=(1, 50, 99)).first()
    assert got.job_count == 100_000
    assert all(abs(got[f"p{p}"] / 100_000 - p / 100) < 0.01 for p in (1, 50, 99))
    nothing = A.sketch_by(values.where("false"), "city", value="pay")
    assert A.sketched_quantiles(A.merged_sketches(nothing, "city"), "city").count() == 0


def test_cleaning_run_writes_and_reports(spark, tmp_path):
    raw = views.postings(spark, SF)
    report = run_cleaning(raw, ["ord"], str(tmp_path / "a"))
    assert rows(report) == rows(cleaning.cleaning_report(raw, ["ord"]))
    cleaned = cleaning.clean_postings(raw, ["ord"])
    for output, expected in (("cleaned", cleaned), ("high_value", cleaning.high_value(cleaned))):
        got = spark.read.schema("ord bigint, `公司名称` string").json(str(tmp_path / "a" / "rows" / f"output={output}"))
        assert rows(got) == rows(expected.select("ord", "company_name"))
    assert sum(1 for p in (tmp_path / "a" / "report").glob("*.json") for _ in open(p, encoding="utf-8")) == report.count()
    again = run_cleaning(raw.where("ord < 100"), ["ord"], str(tmp_path / "a"))
    assert rows(again) == rows(cleaning.cleaning_report(raw.where("ord < 100"), ["ord"]))


def test_cleaning_run_writes_few_bytes(spark, tmp_path, monkeypatch):
    """The repeated keys of the rows are packed, in files of a bounded number of rows."""
    monkeypatch.setattr(cleaning_run, "FILE_ROWS", 100)
    raw = views.postings(spark, SF)
    run_cleaning(raw, ["ord"], str(tmp_path / "a"))
    files = list((tmp_path / "a" / "rows" / "output=cleaned").glob("*.json.gz"))
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    assert sum(t.count(b"\n") for t in texts) == cleaning.clean_postings(raw, ["ord"]).count()
    assert max(t.count(b"\n") for t in texts) <= 100
    assert sum(f.stat().st_size for f in files) < sum(map(len, texts)) / 3


def test_cleaning_run_of_nothing(spark, tmp_path):
    report = run_cleaning(views.postings(spark, SF).where("false"), ["ord"], str(tmp_path / "a"))
    assert rows(report) == [("high_value_count", 0), ("input_count", 0), ("output_count", 0)]
