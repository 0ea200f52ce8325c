"""Batch deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens import vocab as V
from hirelens.functions.text import strip


def _first_of(df: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def row_key(order: list[str], key: str = "job_id") -> list[Column]:
    """What first-wins groups by: the key, and for a blank key the row's own place."""
    return [strip(key), F.when(strip(key) == "", F.struct(*order))]


def first_wins(df: DataFrame, order: list[str], key: str = "job_id") -> DataFrame:
    """Keep the first row, in the given order, of every non-blank key; keep all blank keys.

    Spark rows have no order of their own, so the order columns are required; together
    they identify a row, as a place in the input does. Blank keys are told apart by them,
    so the input is read once. The ``row_number = 1`` filter becomes a group limit that
    each task applies before the exchange: a key that holds a third of all rows sends at
    most one row per task, and blank keys spread over all tasks.
    """
    return _first_of(df, row_key(order, key), order)


def first_content(cleaned: DataFrame, order: list[str]) -> DataFrame:
    """Keep the first row of every company + title + city (D3)."""
    return _first_of(cleaned, [F.col("content_key")], order)


def merge_recruit_types(parts: list[DataFrame], order: list[str]) -> DataFrame:
    """Append listings of several recruit types and keep the first of each id.

    An earlier part wins over a later one, whatever the order inside the parts.
    """
    tagged = [part.withColumn("_part", F.lit(i)) for i, part in enumerate(parts)]
    everything = tagged[0]
    for part in tagged[1:]:
        everything = everything.unionByName(part, allowMissingColumns=True)
    return first_wins(everything, ["_part", *order]).drop("_part")


def merge_by_recruit_type(df: DataFrame, names: dict[str, str], order: list[str]) -> DataFrame:
    """The same for listings that are one table: ``names`` has its recruit types, first ones
    first, and what they are called; rows of other types are left out. Reads the table once."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col("recruit_type"))
    listed = df.withColumn("_part", place).where("_part > 0")
    kept = first_wins(listed, ["_part", *order])
    called = F.element_at(F.array(*map(F.lit, names.values())), F.col("_part").cast("int"))
    return kept.withColumn("recruit_type", called).drop("_part")


def with_recruit_type(df: DataFrame, name: str) -> DataFrame:
    if name not in [n for _, n in V.RECRUIT_BY_URL] + [V.UNKNOWN]:
        raise ValueError(f"unknown recruit type {name!r}")
    return df.withColumn("recruit_type", F.lit(name))
