"""Serving tables refreshed by landed day.

What every rollup is made of - counts, sums, lowest and highest values, quantile sketches - adds up over days. The parts
of a day are a few small rows, kept under ``state/<part>/dt=<day>``; a refresh reads the postings of new days only,
and merges the parts of all days.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators import analytics, rollups
from hirelens.plans.refresh import narrow_jobs, serve, tables_from
from hirelens.sinks.serving import SnapshotTable
from hirelens.sources.files import read_landed
from hirelens.sources.lines import parse_lines, valid_records

# part -> its keys
PARTS = {"single": ["dimension", "value"], "skills": ["skill"], "terms": ["effective_city"], "pay": ["effective_city"]}


def landed_postings(spark: SparkSession, landing: str, day: str) -> DataFrame:
    """The postings of one day; the directories of other days are not read."""
    return valid_records(parse_lines(read_landed(spark, landing).where(F.col("dt") == day)))


def parts_of(postings: DataFrame) -> dict[str, DataFrame]:
    """The parts of some postings, from one reading of them."""
    jobs = narrow_jobs(postings)
    return {
        "single": rollups.all_rollups(jobs), "skills": rollups.skill_sums(jobs),
        "terms": analytics.term_sums(jobs, "effective_city"), "pay": analytics.sketch_by(jobs, "effective_city"),
    }


def add_day(spark: SparkSession, landing: str, state: str, day: str) -> None:
    """Work out the parts of a day and store them. A day that is added again is replaced, not counted twice."""
    for name, part in parts_of(landed_postings(spark, landing, day)).items():
        part.write.mode("overwrite").parquet(f"{state}/{name}/dt={day}")


def merged_parts(spark: SparkSession, state: str) -> dict[str, DataFrame]:
    """The parts of all stored days as one. Reads days times groups small rows, no postings."""
    stored_days = {name: spark.read.parquet(f"{state}/{name}").drop("dt") for name in PARTS}
    merged = {name: rollups.merged_sums(stored_days[name], *PARTS[name]) for name in ("single", "skills", "terms")}
    return {**merged, "pay": analytics.merged_sketches(stored_days["pay"], *PARTS["pay"])}


def refresh_days(
    spark: SparkSession, landing: str, state: str, serving: str, days: Iterable[str], now: Column | None = None
) -> dict[str, SnapshotTable]:
    """Add days and upsert all fifteen serving tables from the parts of all days."""
    for day in days:
        add_day(spark, landing, state, day)
    parts = merged_parts(spark, state)
    return serve(tables_from(parts["single"], parts["skills"], parts["terms"]), serving, now)
