"""Two-pass external shuffle into numbered shards.

Pass one scatters records into memory-sized buckets by a seeded hash of the record. Pass two takes one bucket at a
time, sorts it, which Spark does on disk if need be, and moves its records to Fisher-Yates shuffled places; only the
places pass through Python, not the records. Buckets follow each other in the shuffled order, and shards are equal
ranges of that order, so that shard sizes differ by one row at most.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import store


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of n places."""
    draws = np.random.Generator(np.random.PCG64(seed)).random(n)
    order = array("q", range(n))
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def record_hash(df: DataFrame, seed: int) -> Column:
    """Hash over all columns with their nulls; equal records have equal hashes."""
    return F.xxhash64(F.lit(seed), *[part for c in df.columns for part in (df[c].isNull(), df[c])])


def shuffle_shards(
    df: DataFrame, shards: int, size: Column, seed: int = 17, bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """The records of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0), in shuffled order.

    ``size`` is a record's size in bytes, at least 1. ``df`` should be a stored table: it is read twice, and a lost
    task reads its part again. Runs two aggregates when called. Equal records are spread over buckets too: a record
    whose copies are more than a quarter of a bucket's bytes gets a place per copy, so a bucket stays
    near ``bucket_bytes`` unless a single record is larger. Columns named ``shard`` and ``slot`` are replaced. An empty table gives an empty result; nulls hash as such.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    base = df.select(*kept, size.cast("long").alias("__size"))
    base = base.withColumn("__rec", record_hash(df.select(*kept), seed))
    rows, total = base.agg(F.count("*"), F.sum("__size")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    # records whose copies fill a bucket: one per bucket at most, none as a rule
    often = base.groupBy("__rec").agg(F.count("*").alias("n"), F.sum("__size").alias("bytes"))
    often = store(often.where(F.col("n") > 1).where(F.col("bytes") > bucket_bytes / 4).select("__rec"), "often")
    base = base.withColumn("__place", F.xxhash64(F.lit(seed + 1), "__rec"))
    if not often.isEmpty():
        copies = _numbered_copies(base.join(often, "__rec"), kept, seed)
        copies = copies.withColumn("__place", F.xxhash64(F.lit(seed + 2), "__rec", "__copy")).drop("__copy")
        base = base.join(often, "__rec", "left_anti").unionByName(copies)
    scattered = base.withColumn("__bucket", F.pmod("__place", F.lit(buckets))).drop("__place")
    return _second_pass(scattered, kept, rows, shards, seed)


def _numbered_copies(rows: DataFrame, kept: list[str], seed: int, chunk: int = 1000) -> DataFrame:
    """Repeated records with a number per copy, the same however the rows lie: one of them is copied ``n`` times."""
    other = record_hash(rows.select(*kept), seed + 3)
    # columns, not a struct of them: its fields get lost in Spark's plan below the function of the second pass
    fields = [*kept, "__size"]
    one = rows.groupBy("__rec", other.alias("__other")).agg(
        *[F.first(c).alias(c) for c in fields], F.count("*").alias("__n"))
    chunks = one.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {chunk}"))))
    chunks = chunks.repartition("__rec", "__chunk")
    last = F.least(F.col("__n"), (F.col("__chunk") + 1) * chunk) - 1
    return chunks.withColumn("__copy", F.explode(F.sequence(F.col("__chunk") * chunk, last))).select(
        *fields, "__rec", "__copy")


def shuffled_place(bucket: Column, n: Column, at: Column, seed: int) -> Column:
    """Place after the shuffle of the record that is at ``at`` in its bucket of ``n``; rows of a bucket follow each other."""
    held: dict[int, np.ndarray] = {}  # the bucket at hand

    @F.arrow_udf(T.LongType())
    def place(buckets: pa.Array, counts: pa.Array, ats: pa.Array) -> pa.Array:
        buckets, counts, ats = (x.to_numpy(zero_copy_only=False) for x in (buckets, counts, ats))
        out = np.empty(len(ats), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            number, size = int(buckets[a]), int(counts[a])
            if number not in held:
                held.clear()
                held[number] = np.empty(size, np.int64)
                held[number][fisher_yates(size, [seed, number])] = np.arange(size)
            out[a:b] = held[number][ats[a:b]]
        return pa.array(out, pa.int64())

    return place(bucket, n, at)


def _second_pass(scattered: DataFrame, kept: list[str], rows: int, shards: int, seed: int) -> DataFrame:
    # joined before the exchange by bucket that the second pass needs anyway
    starts = store(bucket_starts(scattered.groupBy("__bucket").agg(F.count("*").alias("n"))), "starts")
    scattered = scattered.join(starts, "__bucket")
    # equal hashes are equal records, so their order does not matter
    at = F.row_number().over(Window.partitionBy("__bucket").orderBy("__rec")).cast("long") - 1
    placed = scattered.withColumn("__pos", at)
    place = shuffled_place(F.col("__bucket"), F.col("__n"), F.col("__pos"), seed)
    placed = placed.withColumn("__at", F.col("__start") + place)
    shard = F.expr(f"cast((__at * {shards}L) div {max(rows, 1)}L as int)")
    placed = placed.withColumn("shard", shard)
    first = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", F.col("__at") - first).select(*kept, "shard", "slot")


def bucket_starts(counts: DataFrame, group: int = 1024) -> DataFrame:
    """Sizes and running totals over bucket numbers, in two levels so that no window holds them all."""
    counts = counts.withColumn("__g", F.expr(f"__bucket div {group}L"))
    totals = counts.groupBy("__g").agg(F.sum("n").alias("gn"))
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__g", F.coalesce(F.sum("gn").over(before), F.lit(0)).alias("gs"))
    within = Window.partitionBy("__g").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("bs", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return counts.join(totals, "__g").select(
        "__bucket", (F.col("gs") + F.col("bs")).alias("__start"), F.col("n").alias("__n"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; its files follow each other, and rows are in slot order within each."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
