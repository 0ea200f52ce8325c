"""Orderings, top-k and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.session import stored


def top_k(df: DataFrame, k: int, measure: str, *tie_break: str) -> DataFrame:
    """The k largest by a measure, ties by key (O1). Runs as a per-task top-k, no full sort."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Key order, as bytes (O2)."""
    return df.orderBy(*keys)


def running_totals(counts: DataFrame, keys: list[str], by: Column, n: str) -> DataFrame:
    """Add ``_upto`` (running sum of ``n`` within the keys, in order) and ``_total``.

    Rows have to be distinct over keys and order, as a histogram is. A plain window would
    give a whole group, or without keys the whole table, to one task. Here ranges of
    (keys, order) are the unit: distinct rows split into even ranges however the groups
    are sized, each range sums on its own, and only one number per range and key - the
    sum of the ranges before it - goes through a window over the group.

    The ranges are stored, so that sums and offsets are of the same ranges.
    """
    ranged = counts.repartitionByRange(*[F.col(k) for k in keys], by)
    ranges = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy(*keys, "_range").agg(F.sum(n).alias("_sum"))
    offsets = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_k_range"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(group).alias("_total"),
    )
    same = F.col("_range") == F.col("_k_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_range").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum(n).over(inside)
    placed = ranges.join(offsets, same).withColumn("_upto", upto)
    return placed.select(*counts.columns, "_upto", "_total")


def ranked(df: DataFrame, measure: str, name: str = "rank") -> DataFrame:
    """Add the competition rank (1, 2, 2, 4, ...) by a measure, largest first.

    The rank of a row only depends on how many rows have a larger measure, so running
    totals are taken over the histogram of the measure and joined back. The table is
    stored first: it is read twice, and what it was aggregated from should not be.
    """
    df = stored(df, "ranked")
    histogram = df.groupBy(F.col(measure).alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    places = running_totals(histogram, [], F.desc("_m"), "_n").select(
        "_m", (F.col("_upto") - F.col("_n") + 1).alias(name)
    )
    return df.join(places, df[measure].eqNullSafe(places["_m"])).drop("_m")
