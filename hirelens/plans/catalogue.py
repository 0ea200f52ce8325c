"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions import description, links, numbers, repair, salary, text, title
from hirelens.operators import analytics as A
from hirelens.operators import cards as C
from hirelens.operators import cleaning, dedup, quality, ranking, rollups
from hirelens.operators.records import enrich
from hirelens.plans import daily, views
from hirelens.plans.cleaning_run import run_cleaning
from hirelens.plans.refresh import refresh, served_rows
from hirelens.schema import COLUMNS, SERVING, SOURCE_KEYS
from hirelens.session import open_directories, scratch_dir, spread
from hirelens.sinks import files as file_sink
from hirelens.sinks import serving
from hirelens.sinks import topic as topic_sink
from hirelens.sources import files, lines, pages, topic
from hirelens.streaming import jobs as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

JOIN = F.array_join


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _over_jobs(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(views.jobs(spark, sf_dir))


# --- the fifteen rollups -------------------------------------------------------

ROLLUPS = {
    "city_job_count": rollups.city_job_count,
    "city_salary_stats": rollups.city_salary_stats,
    "skill_count": rollups.skill_count,
    "skill_salary_stats": rollups.skill_salary_stats,
    "education_count": rollups.education_count,
    "education_salary_stats": rollups.education_salary_stats,
    "company_type_count": rollups.company_type_count,
    "recruit_type_count": rollups.recruit_type_count,
    "internship_stats": rollups.internship_stats,
    "dashboard_summary": rollups.dashboard_summary,
    "high_collection": rollups.high_collection,
    "active_jobs": rollups.active_jobs,
    "negotiable_ratio": rollups.negotiable_ratio,
    "skill_collection_rank": rollups.skill_collection_rank,
    "activity_salary": rollups.activity_salary,
    "high_collection_salary": rollups.high_collection_salary,
    "all_rollups": rollups.all_rollups,
    "all_skill_rollups": rollups.all_skill_rollups,
}
for _name, _build in ROLLUPS.items():
    _over_jobs(_name, _build)


# --- top-k and ranks -----------------------------------------------------------


@query
def top10_cities(spark, sf_dir):
    return ranking.top_k(rollups.city_job_count(views.jobs(spark, sf_dir)), 10, "job_count", "city")


@query
def top100_favourites(spark, sf_dir):
    jobs = views.jobs(spark, sf_dir).select(
        "ord", "job_id", "job_name", "company_name", "collection_count"
    )
    return A.top_favourites(jobs, 100, "ord")


@query
def skill_ranking_filtered(spark, sf_dir):
    return A.skill_ranking(views.jobs(spark, sf_dir), cities=["北京", "上海"], job_types=["后端开发", "测试"])


# --- field rules ---------------------------------------------------------------


@query
def salary_struct(spark, sf_dir):
    p = views.postings(spark, sf_dir).select(
        "ord", salary.salary_struct(text.strip("salary")).alias("pay")
    )
    return p.select("ord", *[F.col(f"pay.{f}").alias(f"pay_{f}") for f in _PAY])


_PAY = ["min", "max", "months", "negotiable", "raw"]


@query
def salary_yuan(spark, sf_dir):
    return views.jobs(spark, sf_dir).select(
        "ord", "min_salary", "max_salary", "salary_months", "negotiable",
        "avg_monthly_salary", "annual_salary",
    )


@query
def job_fields(spark, sf_dir):
    return views.jobs(spark, sf_dir).select(
        "ord", "effective_city", "collection_count", "activity_label", "is_active",
        "is_internship", "is_high_collection", JOIN("skills", "|").alias("skills"),
    )


@query
def description_fields(spark, sf_dir):
    desc = text.strip("job_desc")
    return views.postings(spark, sf_dir).select(
        "ord",
        description.favourites(desc).alias("favourites"),
        description.activity_marks(desc).alias("activity_marks"),
        description.city_in_text(desc).alias("city_candidate"),
        description.degree_in_text(desc).alias("degree_candidate"),
        description.family_in_text(desc).alias("job_family"),
        description.company_in_text(desc).alias("company_candidate"),
    )


@query
def document_fields(spark, sf_dir):
    """The dictionary rules over the whole text of every document."""
    doc = text.strip("text")
    return spread(views.table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id",
        description.family_in_text(doc).alias("job_family"),
        description.company_in_text(doc).alias("company_candidate"),
        F.length(doc).alias("text_length"),
    )


@query
def title_fields(spark, sf_dir):
    name = title.clean_title("job_name")
    return views.postings(spark, sf_dir).select(
        "ord",
        name.alias("clean_title"),
        title.city_in_title(name).alias("city_from_title"),
        title.batch_in_title(name).alias("title_batch"),
        title.is_valid_title(name).alias("is_valid_job"),
        title.standard_title("job_name").alias("standard_title"),
        title.job_code(F.concat("job_name", F.lit("-J"), F.col("job_id"))).alias("job_code"),
    )


@query
def company_repair(spark, sf_dir):
    company = text.strip("company_name")
    candidate = description.company_in_text(text.strip("job_desc"))
    return views.postings(spark, sf_dir).select(
        "ord",
        repair.is_company_tag(company).alias("is_tag"),
        repair.repaired_company(company, candidate).alias("company_name"),
    )


@query
def value_tags(spark, sf_dir):
    desc = text.strip("job_desc")
    tags = repair.value_tags(description.favourites(desc), description.activity_marks(desc), hr_tag=True)
    return views.postings(spark, sf_dir).select("ord", JOIN(tags, "|").alias("value_tags"))


@query
def text_signals(spark, sf_dir):
    """Percentile, deadline, board and channel marks in descriptions."""
    desc = F.expr(
        "job_desc || chr(10) || '薪资超' || CAST(ord % 100 AS STRING) || '%同类职位' || chr(10) || "
        + views.pick("ord % 4", "还有3天截止", "HC充足榜", "简历直投官网")
    )
    found = views.postings(spark, sf_dir).select(F.explode(description.signals(desc)).alias("signal"))
    return rollups.count_by(found, "signal")


@query
def link_fields(spark, sf_dir):
    p = views.cards(spark, sf_dir)
    link = links.absolute_link("href", views.BASE_URL)
    listing = F.expr(
        f"'{views.BASE_URL}/' || "
        + views.pick("card_id % 4", "school/list", "intern/list", "fulltime/list")
    )
    return p.select(
        "card_id", link.alias("link"), links.id_from_link(link).alias("job_id"),
        links.recruit_type_from_url(listing).alias("recruit_type"),
    )


# --- cleaning ------------------------------------------------------------------


def _flat(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "ord", "job_id", "job_name", "company_name", "city", "education", "job_type", "salary",
        "is_valid_job", *[F.col(f"parsed_salary.{f}").alias(f"pay_{f}") for f in _PAY],
        "collection_count", "active_status", "batch", JOIN("value_tags", "|").alias("value_tags"),
    )


@query
def cleaned_postings(spark, sf_dir):
    return _flat(cleaning.clean_postings(views.postings(spark, sf_dir), ["ord"]))


@query
def high_value_jobs(spark, sf_dir):
    cleaned = cleaning.clean_postings(views.postings(spark, sf_dir), ["ord"])
    return _flat(cleaning.high_value(cleaned))


@query
def meaningful_jobs(spark, sf_dir):
    cleaned = cleaning.clean_postings(views.postings(spark, sf_dir), ["ord"])
    return cleaning.meaningful(cleaned).select("ord", "job_id", "job_name")


@query
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(views.postings(spark, sf_dir), ["ord"])


@query
def content_duplicates(spark, sf_dir):
    return cleaning.content_duplicates(cleaning.repair_fields(views.postings(spark, sf_dir)))


@query
def dedup_first_wins(spark, sf_dir):
    return dedup.first_wins(views.postings(spark, sf_dir).select("ord", "job_id"), ["ord"])


@query
def dedup_content(spark, sf_dir):
    repaired = cleaning.repair_fields(views.postings(spark, sf_dir))
    return dedup.first_content(repaired.select("ord", "content_key"), ["ord"])


@query
def normalised_titles(spark, sf_dir):
    return cleaning.normalise_titles(views.postings(spark, sf_dir)).select(
        "ord", "standard_title", "company_name", "salary"
    )


@query
def union_recruit_types(spark, sf_dir):
    p = views.postings(spark, sf_dir).select("ord", "job_id", "recruit_type")
    names = {"校招": "校招", "实习": "实习", "社招": "社招", "": V.UNKNOWN}
    return dedup.merge_by_recruit_type(p, names, ["ord"])


@query
def repaired_values(spark, sf_dir):
    """Invisible characters, a cut-off suffix and pay left in the title."""
    rough = views.postings(spark, sf_dir).select(
        "ord",
        F.expr(views.pick("ord % 3", "某\u200b有限", "某有限 ", default="company_name")).alias("company_name"),
        F.concat("job_name", F.expr(views.pick("ord % 3", "15-25K", "20k~30k"))).alias("job_name"),
        F.lit("").alias("salary"),
    )
    return cleaning.normalise_titles(rough).select("ord", "company_name", "salary")


@query
def filled_from_text(spark, sf_dir):
    """Cities after a dash of the title, pay stated in the description, and job categories."""
    rough = views.postings(spark, sf_dir).select(
        "ord", "city",
        F.expr("job_name || CASE ord % 4 WHEN 0 THEN '-武汉' WHEN 1 THEN '-某地' ELSE '' END").alias("job_name"),
        F.expr("CASE WHEN ord % 3 = 0 THEN '' ELSE salary END").alias("salary"),
        F.expr("job_desc || CASE WHEN ord % 2 = 0 THEN chr(10) || '薪资 20-40K·17薪' ELSE '' END").alias("job_desc"),
    )
    return cleaning.fill_from_text(rough).select("ord", "city", "salary", "job_category")


@query
def well_formed_jobs(spark, sf_dir):
    """Meaningful rows without malformed ids."""
    odd = F.expr("CASE WHEN ord % 11 = 0 THEN 'J-' || job_id ELSE job_id END")
    cleaned = cleaning.clean_postings(views.postings(spark, sf_dir).withColumn("job_id", odd), ["ord"])
    return cleaning.well_formed(cleaned).select("ord", "job_id")


# --- analytics -----------------------------------------------------------------


@query
def city_salary_quantiles(spark, sf_dir):
    return A.quantiles_by(views.jobs(spark, sf_dir), ["effective_city"])


@query
def skill_salary_quantiles(spark, sf_dir):
    slim = views.jobs(spark, sf_dir).select("skills", rollups.MID)
    return A.quantiles_by(A.explode_skills(slim), ["skill"])


@query
def education_salary_quantiles(spark, sf_dir):
    return A.quantiles_by(rollups.not_blank(views.jobs(spark, sf_dir), "education"), ["education"])


@query
def city_salary_histogram(spark, sf_dir):
    return A.histogram_by(views.jobs(spark, sf_dir), "effective_city")


_over_jobs("education_share", lambda j: A.share_by(j, "education"))
_over_jobs("job_type_salary", lambda j: A.share_by(j, "job_type"))
_over_jobs("company_type_salary", lambda j: A.share_by(j, "company_type"))
_over_jobs("company_nature_salary", lambda j: A.share_by(j, "company_nature"))
_over_jobs("internship_vs_regular", A.internship_vs_regular)
_over_jobs("internship_terms", lambda j: A.internship_terms(j, "effective_city", "company_type"))
_over_jobs("internship_term_distribution", A.term_distribution)
_over_jobs("recruit_by_year", lambda j: A.cross_cube(j, "recruit_type", "graduate_year"))
_over_jobs("city_skill_matrix", A.city_skill_matrix)
_over_jobs("skill_jobtype_matrix", A.skill_job_type_matrix)
_over_jobs("education_city_cube", lambda j: A.cross_cube(j, "education", "effective_city"))
_over_jobs("city_competition", A.city_competition)
_over_jobs("active_companies", A.active_companies)
_over_jobs("overview", A.overview)
_over_jobs("negotiable_by_company_type", lambda j: rollups.negotiable_ratio(j, "company_type", "company_type"))


@query
def education_city_pivot(spark, sf_dir):
    wide = A.pivot_matrix(
        views.jobs(spark, sf_dir), "effective_city", "education", ["本科", "硕士", "博士"]
    )
    return wide.withColumnsRenamed({"本科": "bachelor", "硕士": "master", "博士": "doctor"})


@query
def filtered_compare(spark, sf_dir):
    chosen = A.matching(
        views.jobs(spark, sf_dir), cities=["北京", "上海", "深圳"], skills=["Java", "Go"],
        educations=["本科", "博士"],
    )
    return A.rollup_by(chosen, ["effective_city", "education"], list(A.METRICS))


@query
def high_pay_high_favourite(spark, sf_dir):
    chosen = A.high_pay_high_favourite(views.jobs(spark, sf_dir), pay_from=20000)
    return chosen.select("ord", "job_id", "avg_monthly_salary", "collection_count")


@query
def favourite_jobs(spark, sf_dir):
    return A.favourite_jobs(views.jobs(spark, sf_dir)).select("ord", "collection_count")


@query
def hr_active_jobs(spark, sf_dir):
    return A.hr_active_jobs(views.jobs(spark, sf_dir)).select("ord", "job_name")


# --- quality -------------------------------------------------------------------


@query
def quality_profile(spark, sf_dir):
    return quality.profile(views.postings(spark, sf_dir).drop("o_orderdate"))


@query
def quality_change(spark, sf_dir):
    raw = views.postings(spark, sf_dir)
    fields = ["job_name", "company_name", "city", "education", "job_type"]
    return quality.change_by(raw, cleaning.repair_fields, fields)


@query
def review_sample(spark, sf_dir):
    return quality.review_sample(views.postings(spark, sf_dir).select("ord", "job_name"), "ord")


# --- input and output ----------------------------------------------------------


@query
def tolerant_lines(spark, sf_dir):
    rows = lines.parse_lines(views.text_lines(spark, sf_dir))
    return rows.select("ord", "job_name", "city", "salary", "job_id", "company_name", "corrupt_line")


@query
def strict_lines(spark, sf_dir):
    rows = lines.parse_lines(views.text_lines(spark, sf_dir), strict_compat=True)
    return rows.select("ord", "job_name", "city", "salary", "job_id", "company_name")


@query
def job_counters(spark, sf_dir):
    return rollups.job_counters(enrich(lines.parse_lines(views.text_lines(spark, sf_dir), keep_all=True)))


@query
def line_city_count(spark, sf_dir):
    """A rollup over lines with junk among them."""
    records = lines.valid_records(lines.parse_lines(views.text_lines(spark, sf_dir)))
    return rollups.count_by(records, "city")


@query
def topic_messages(spark, sf_dir):
    """Rows -> keyed messages -> rows."""
    slim = views.postings(spark, sf_dir).select("job_id", "job_name", "company_name", "salary", "city")
    back = topic.message_rows(topic_sink.posting_messages(slim))
    return back.select("key", "job_id", "job_name", "company_name", "salary", "city")


@query
def message_detail(spark, sf_dir):
    slim = views.postings(spark, sf_dir)
    sent = topic_sink.message_of(slim.select("job_id", "job_name", "company_name", F.nullif("salary", F.lit("")).alias("salary"), "ord"))
    k = F.get_json_object("value", "$.ord").cast("bigint")
    placed = sent.withColumns({"offset": k, "partition": (k % 3).cast("int")})
    return topic.message_detail(placed)


@query
def upsert_snapshot(spark, sf_dir):
    """Jobs per company as loaded up to a day, then updated with the later load."""
    p = views.postings(spark, sf_dir).withColumnRenamed("company_name", "company")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    base = rollups.count_by(p.where(F.col("o_orderdate") < cut), "company").withColumn(
        "update_time", F.lit("2026-01-01")
    )
    delta = rollups.count_by(p.where(F.col("o_orderdate") >= cut), "company")
    return serving.upsert(base, delta, ["company"], now=F.lit("2026-01-02"))


@query
def serving_city_salary(spark, sf_dir):
    rollup = rollups.city_salary_stats(views.jobs(spark, sf_dir))
    typed = serving.serving_table(rollup, "city_salary_stats")
    return typed.withColumn("avg_salary", F.col("avg_salary").cast("double"))


@query
def serving_internship(spark, sf_dir):
    """The internship table as its definition has it: count, mean duration, conversion rate."""
    terms = A.internship_terms(views.jobs(spark, sf_dir), "effective_city").withColumnRenamed(
        "effective_city", "city"
    )
    typed = serving.serving_table(terms, "internship_stats")
    return typed.withColumn("conversion_rate", F.col("conversion_rate").cast("double"))


@query
def serving_refresh(spark, sf_dir):
    """All fifteen serving tables refreshed and read back, all measures."""
    return served_rows(refresh(views.postings(spark, sf_dir), scratch_dir(spark, "serving")))


@query
def daily_refresh(spark, sf_dir):
    """Postings landed on three days, the serving tables refreshed after each from that day's postings alone."""
    landing, state, tables = (scratch_dir(spark, name) for name in ("landing", "parts", "serving"))
    _land_by_day(views.postings(spark, sf_dir), landing)
    for day in DAYS:
        written = daily.refresh_days(spark, landing, state, tables, [day])
    return served_rows(written)


DAYS = ["20260101", "20260102", "20260103"]


def _land_by_day(postings: DataFrame, root: str) -> None:
    """Postings as JSON lines under a directory per day, a third of them each."""
    day = F.element_at(F.array(*map(F.lit, DAYS)), (F.col("ord") % 3 + 1).cast("int"))
    line = F.to_json(F.struct(*[F.col(c).alias(k) for k, c in SOURCE_KEYS.items()]))
    with open_directories(postings.sparkSession, len(DAYS) + 1):
        postings.select(line.alias("value"), day.alias("dt")).write.partitionBy("dt").text(root)


@query
def city_salary_sketch(spark, sf_dir):
    """Quantiles per city out of merged sketches of three days: does the rank of each answer lie within 2 %?"""
    jobs = views.jobs(spark, sf_dir).select("ord", "effective_city", rollups.MID)
    by_day = A.sketch_by(jobs.withColumn("day", F.col("ord") % 3), "day", "effective_city")
    told = A.sketched_quantiles(A.merged_sketches(by_day, "effective_city"), "effective_city")
    names = [c for c in told.columns if c.startswith("p")]
    answers = told.unpivot(["effective_city", "job_count"], names, "quantile", "answer")
    exact = jobs.groupBy("effective_city", rollups.MID).agg(F.count(F.lit(1)).alias("n"))
    ranks = answers.join(exact, "effective_city").groupBy("effective_city", "job_count", "quantile").agg(
        F.sum(F.when(F.col(rollups.MID) < F.col("answer"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col(rollups.MID) <= F.col("answer"), F.col("n")).otherwise(0)).alias("upto"))
    asked = F.substring("quantile", 2, 2).cast("int") / 100
    return ranks.select(
        "effective_city", "quantile", "job_count",
        ((F.col("below") / F.col("job_count") <= asked + 0.02) & (F.col("upto") / F.col("job_count") >= asked - 0.02))
        .alias("within_bound"))


@query
def cleaning_run(spark, sf_dir):
    """Rows, high-value rows and report of one cleaning run, all three read back."""
    root = scratch_dir(spark, "cleaning-run")
    report = run_cleaning(views.postings(spark, sf_dir), ["ord"], root)
    rows = spark.read.schema("output string, ord bigint, collection_count bigint").json(f"{root}/rows")
    return rows.select("output", F.col("ord").cast("string").alias("name"), F.col("collection_count").alias("value")).union(
        report.select(F.lit("report"), "metric", "value"))


@query
def json_files(spark, sf_dir):
    """Postings written as JSON lines and read back."""
    path = scratch_dir(spark, "json")
    file_sink.write_json(views.postings(spark, sf_dir).select(*COLUMNS), path)
    return files.read_posting_lines(spark, path).select(*COLUMNS)


@query
def json_array(spark, sf_dir):
    """Postings written as files of one JSON array each and read back."""
    path = scratch_dir(spark, "arrays")
    posting = F.struct(*[F.col(c).alias(k) for k, c in SOURCE_KEYS.items()])
    rows = views.postings(spark, sf_dir)
    arrays = rows.groupBy(F.floor(F.col("ord") / 5000)).agg(F.to_json(F.collect_list(posting)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_posting_array_ordered(spark, path).select(*COLUMNS)


@query
def high_value_file(spark, sf_dir):
    """The rows with a value tag, written and read back."""
    path = scratch_dir(spark, "high-value")
    file_sink.write_high_value(cleaning.clean_postings(views.postings(spark, sf_dir), ["ord"]), path)
    return spark.read.schema("ord bigint, job_id string, collection_count bigint").json(path)


@query
def report_file(spark, sf_dir):
    """The report of a cleaning run, written and read back."""
    path = scratch_dir(spark, "report")
    file_sink.write_report(cleaning.cleaning_report(views.postings(spark, sf_dir), ["ord"]), path)
    return spark.read.schema("metric string, value bigint").json(path)


@query
def csv_file(spark, sf_dir):
    """The flat export as CSV, read back."""
    path = scratch_dir(spark, "csv")
    postings = views.postings(spark, sf_dir)
    file_sink.export_csv(postings, path)
    schema = file_sink.export_projection(postings).schema
    # a null value other than blank keeps quoted blanks apart from nulls
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True, nullValue="\\N").csv(path)


@query
def tsv_file(spark, sf_dir):
    """A tab-separated result that replaces an earlier one, read back."""
    path = scratch_dir(spark, "tsv")
    counts = rollups.city_job_count(views.jobs(spark, sf_dir))
    file_sink.write_tsv(counts.where("job_count < 0"), path)
    file_sink.write_tsv(counts, path, replace=True)
    return spark.read.schema(counts.schema).option("sep", "\t").csv(path)


@query
def taken_messages(spark, sf_dir):
    """How many messages a reader gets that stops after a hundred."""
    sent = topic_sink.posting_messages(views.postings(spark, sf_dir).select("job_id", "job_name"))
    return topic.take_messages(sent, 100).agg(F.count(F.lit(1)).alias("message_count"))


@query
def tapped_messages(spark, sf_dir):
    """Every event message seen by the file side of the debug tap, counted by type."""
    scratch = scratch_dir(spark, "tap")
    events = _stream(spark, sf_dir, "events").select(F.col("event_type").alias("value"))
    streaming.debug_tap(
        events, f"{scratch}/out", f"{scratch}/state", log=lambda line: None, trigger=streaming.ONCE
    ).awaitTermination()
    return rollups.count_by(spark.read.text(f"{scratch}/out/batch=*"), "value", name="message_count")


@query
def export_rows(spark, sf_dir):
    """The flat export, with source key names."""
    return file_sink.export_projection(views.postings(spark, sf_dir))


@query
def page_links(spark, sf_dir):
    found = pages.page_links(
        views.table(spark, sf_dir, "pages"), views.BASE_URL, "[^\"]*", "html", "page_id"
    )
    return found


@query
def listing_links(spark, sf_dir):
    return pages.page_links(
        views.anchors(spark, sf_dir), views.BASE_URL, pages.JOB_HREF, "html", "page_id"
    )


@query
def card_fields(spark, sf_dir):
    parsed = C.parse_cards(views.cards(spark, sf_dir), views.BASE_URL)
    return parsed.drop("card_text", "href").withColumn("rejection", C.rejection(views.SITE))


@query
def rejected_cards(spark, sf_dir):
    parsed = C.parse_cards(views.cards(spark, sf_dir), views.BASE_URL)
    return C.rejected_counts(parsed, views.SITE)


# --- streams -------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream. The glob also matches a plain file, which a stream
    would not take as its directory."""
    schema = views.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


@query
def stream_landing(spark, sf_dir):
    """Postings as messages, landed under a dated directory, read back and counted."""
    scratch = scratch_dir(spark, "landing")
    orders = _stream(spark, sf_dir, "orders")
    customers = views.table(spark, sf_dir, "customer")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    messages = topic_sink.posting_messages(views.postings_of(rows))
    landing = streaming.land(
        messages, f"{scratch}/out", f"{scratch}/state",
        clock=F.lit("2026-01-02 03:04:05").cast("timestamp"), trigger=streaming.ONCE,
    )
    landing.awaitTermination()
    landed = files.read_landed(spark, f"{scratch}/out").where("dt = '20260102'")
    records = enrich(lines.valid_records(lines.parse_lines(landed)))
    named = records.withColumnRenamed("effective_city", "_city").select(
        "dt", F.col("_city").alias("city"), rollups.MID
    )
    return named.groupBy("dt", "city").agg(
        F.count(F.lit(1)).alias("job_count"),
        numbers.whole_div(F.sum(rollups.MID), F.count(rollups.MID)).alias("avg_salary"),
    )


@query
def stream_dedup(spark, sf_dir):
    """Users seen in the event stream, each once."""
    scratch = scratch_dir(spark, "dedup")
    events = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    seen = streaming.first_seen(events, "user_id").select("user_id")
    (
        seen.writeStream.format("parquet").option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/state").trigger(**streaming.ONCE).start()
        .awaitTermination()
    )
    return spark.read.schema(seen.schema).parquet(f"{scratch}/out")


@query
def partition_counts(spark, sf_dir):
    """Running message counts of an event stream keyed to three partitions."""
    scratch = scratch_dir(spark, "counts")
    events = _stream(spark, sf_dir, "events")
    messages = events.withColumn("partition", (F.col("user_id") % 3).cast("int"))
    state = streaming.write_state(
        streaming.partition_counts(messages), f"{scratch}/out", f"{scratch}/state", streaming.ONCE
    )
    state.awaitTermination()
    newest = max((p["batchId"] for p in state.recentProgress), default=None)
    if newest is None:  # a stream without a row has no batch
        return spark.createDataFrame([], "partition int, message_count bigint")
    return ranking.by_key(spark.read.parquet(f"{scratch}/out/batch={newest}"), "partition")


@query
def stream_dedup_table(spark, sf_dir):
    """Users seen in the event stream, each once, their ids kept in a table instead of the state store."""
    scratch = scratch_dir(spark, "ids")
    events = _stream(spark, sf_dir, "events").select("user_id")
    streaming.land_first_seen(events, "user_id", f"{scratch}/out", f"{scratch}/state", streaming.ONCE).awaitTermination()
    return streaming.first_seen_rows(spark, f"{scratch}/out", events.schema)


@query
def rolled_landing(spark, sf_dir):
    """Event messages landed in files that roll by size, read back and counted by type."""
    scratch = scratch_dir(spark, "rolled")
    messages = _stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("value"), (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    streaming.land_rolled(
        messages, f"{scratch}/out", f"{scratch}/state", clock=F.lit("2026-01-02 03:04:05").cast("timestamp"),
        trigger=streaming.ONCE, roll_bytes=64 << 10,
    ).awaitTermination()
    return rollups.count_by(files.read_landed(spark, f"{scratch}/out"), "dt", "value", name="message_count")


@query
def stream_totals(spark, sf_dir):
    """Rows of a whole stream run, from the progress of all its batches."""
    scratch = scratch_dir(spark, "progress")
    with streaming.ProgressTable(spark, f"{scratch}/progress") as progress:
        run = (
            _stream(spark, sf_dir, "events").writeStream.format("noop")
            .option("checkpointLocation", f"{scratch}/state").trigger(**streaming.ONCE).start()
        )
        run.awaitTermination()
        progress.wait(run)
    return progress.totals().select("rows")
