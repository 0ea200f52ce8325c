"""Times the headline queries once warm and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from hirelens.plans.catalogue import QUERIES
from hirelens.session import local_session

HEADLINE = [
    "city_job_count", "city_salary_stats", "skill_count", "skill_salary_stats", "education_count",
    "education_salary_stats", "company_type_count", "recruit_type_count", "internship_stats",
    "dashboard_summary", "high_collection", "active_jobs", "negotiable_ratio",
    "skill_collection_rank", "activity_salary", "all_rollups", "top10_cities", "top100_favourites",
    "cleaned_postings", "cleaning_report", "dedup_first_wins", "description_fields",
    "document_fields", "city_salary_quantiles", "skill_salary_quantiles", "education_share",
    "education_city_cube", "city_skill_matrix", "filtered_compare", "city_competition",
    "active_companies", "quality_profile", "tolerant_lines", "upsert_snapshot", "page_links",
    "card_fields", "stream_landing", "partition_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # the tables are one file, and so one task, each: spread their rows over the cores unless told otherwise
    spread = os.environ.get("BENCH_SPREAD", cpus if cpus.isdigit() else "0")
    spark = local_session(cpus, **{"spark.hirelens.spread": spread})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # one pass over the smallest data compiles the plans and warms the JVM
    warm = Path(sf_dir).parent / "sf0.001"
    if warm.exists():
        for name in names:
            QUERIES[name](spark, str(warm)).write.format("noop").mode("overwrite").save()
    times = {name: round(run(name), 3) for name in names}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
