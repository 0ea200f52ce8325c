"""Data quality: fill rates, change between two versions, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.numbers import percent


def _filled(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    c = F.col(column)
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    if kind == "array":
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(field, filled, total, rate) per column, from one scan and one aggregate.

    The per-column counters are one wide row per task; they are turned into rows only
    after the final aggregate.
    """
    columns = columns or df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_filled(df, c)).alias(c) for c in columns],
    )
    return (
        wide.unpivot(["total"], list(columns), "field", "filled")
        .select("field", "filled", "total", percent(F.col("filled"), F.col("total")).alias("rate"))
    )


def compare_profiles(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Fill rate before and after a step, per field (R25). Inputs: the two tables."""
    b = profile(before, columns).select("field", F.col("rate").alias("rate_before"))
    a = profile(after, columns).select("field", F.col("rate").alias("rate_after"))
    return b.join(a, "field").withColumn(
        "change", F.round(F.col("rate_after") - F.col("rate_before"), 2)
    )


def change_by(df: DataFrame, step: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """The same for a row-wise step that keeps further columns, from one reading and one aggregate."""
    done = step(df.withColumns({f"_was_{c}": F.col(c) for c in columns}))
    wide = done.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_filled(done, c)).alias(c) for name in columns for c in (f"_was_{name}", name)],
    )
    rate = lambda c: percent(F.col(c), F.col("_total"))
    fields = [F.struct(F.lit(c).alias("field"), rate(f"_was_{c}").alias("rate_before"), rate(c).alias("rate_after"))
              for c in columns]
    return wide.select(F.inline(F.array(*fields))).withColumn(
        "change", F.round(F.col("rate_after") - F.col("rate_before"), 2)
    )


def review_sample(df: DataFrame, key: str, n: int = 50, seed: str = "review") -> DataFrame:
    """n rows for manual review.

    Ordered by a hash of the key, so a sample can be drawn again and does not depend
    on how the data is partitioned; runs as a per-task top-n.
    """
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(n)
