"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives each distinct vector a long bit string (signs of random projections) and keeps the strings in sorted
arrays. A query descends to its place in each array, where the entries around it share the longest prefixes with it,
and then ascends in all trees at once: candidates are taken in order of falling prefix length until there are enough.
Their cosines are computed exactly. Every vector is indexed; nothing is fitted but the splitters of the arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import store

BITS = 62


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part.

    Null and zero vectors, those with null or non-finite components, null ids, and vectors that do not have the most
    frequent number of components take no part.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (common["d"] if common else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector: key, vec, norm, its least ids (at most ``ids`` of them) in order.

    Rows repeated with the same id and vector count once.
    """
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + 0.0))  # -0.0 becomes 0.0
    rows = rows.withColumn("h1", F.xxhash64(F.lit(1), "vec")).withColumn("h2", F.xxhash64(F.lit(2), "vec"))
    place = F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    least = rows.withColumn("place", place).where(F.col("place") <= ids)
    groups = least.groupBy("h1", "h2").agg(
        F.first("vec").alias("vec"), F.array_sort(F.collect_set("vec_id")).alias("ids"))
    # a cosine does not change with the length of a vector; very long and very short ones would leave the range
    top = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    scaled = F.when(top.between(1e-100, 1e100), F.col("vec")).otherwise(F.transform("vec", lambda x: x / top))
    groups = groups.withColumn("vec", scaled)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    return groups.select(F.col("h1").alias("key"), "vec", norm.alias("norm"), "ids")


class Forest:
    """Sorted arrays of hash strings over one block of vectors."""

    def __init__(self, vectors: np.ndarray, trees: int, seed: int):
        self.trees = trees
        planes = np.random.Generator(np.random.PCG64(seed)).standard_normal((vectors.shape[1], trees * BITS))
        self.planes = planes.astype(np.float32)
        codes = self.strings(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """One hash string per tree (rows) and vector (columns)."""
        out = np.empty((self.trees, len(vectors)), np.int64)
        powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for at in range(0, len(vectors), 1000):
            part = vectors[at:at + 1000]
            part = (part / np.abs(part).max(axis=1, keepdims=True)).astype(np.float32)
            bits = (part @ self.planes > 0).reshape(len(part), self.trees, BITS)
            out[:, at:at + 1000] = (bits * powers).sum(axis=2).T
        return out

    def candidates(self, queries: np.ndarray, enough: float) -> Iterator[np.ndarray]:
        """Per query, the entries met when all trees ascend together until ``enough`` entries have been counted.

        A tree's longest match is the deepest level at which its sorted array has entries with the query's prefix; at
        shallower levels the matches are longer ranges of the array. The last level is taken tree by tree.
        """
        strings = self.strings(queries)
        levels = np.arange(BITS, -1, -1)
        low = np.empty((len(levels), *strings.shape), np.int32)
        high = np.empty_like(low)
        for i, level in enumerate(levels):
            shift = BITS - level
            first = (strings >> shift) << shift
            for t in range(self.trees):
                low[i, t] = np.searchsorted(self.codes[t], first[t], "left")
                high[i, t] = np.searchsorted(self.codes[t], first[t] + (1 << int(shift)) - 1, "right")
        met = (high - low).sum(axis=1)  # level, query
        for q in range(len(queries)):
            stop = min(int(np.argmax(met[:, q] >= enough)) if (met[:, q] >= enough).any() else BITS, BITS)
            level = np.full(self.trees, max(stop - 1, 0))
            gain = np.cumsum((high - low)[stop, :, q] - (high - low)[level[0], :, q]) + met[level[0], q]
            level[:int(np.searchsorted(gain, enough)) + 1] = stop
            seen = np.zeros(self.codes.shape[1], bool)
            for t in range(self.trees):
                seen[self.order[t, low[level[t], t, q]:high[level[t], t, q]]] = True
            yield np.flatnonzero(seen)


def searched(entries: DataFrame, asked: DataFrame, keep: int, trees: int, enough: int, share: float, seed: int) -> DataFrame:
    """query, key, first id and score of the ``keep`` best candidates of each query in each block and part."""

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if block.num_rows and queries.num_rows:
            matrix = lambda t: np.array(t.column("vec").combine_chunks().to_pylist(), float)
            vec, norm = matrix(block), block.column("norm").to_numpy()
            key, least = block.column("key").to_numpy(), block.column("least").to_numpy()
            asked_vec, asked_norm = matrix(queries), queries.column("norm").to_numpy()
            asked_key = queries.column("key").to_numpy()
            forest = Forest(vec, trees, seed)
            need = max(enough, -np.log(1 - share) * len(vec))  # as entries are met more than once
            for at in range(0, len(asked_key), 100):
                part = slice(at, at + 100)
                for q, found in enumerate(forest.candidates(asked_vec[part], need), at):
                    score = np.einsum("ij,j->i", vec[found], asked_vec[q]) / (norm[found] * asked_norm[q])
                    best = np.lexsort((least[found], -score))[:keep]
                    rows += zip([int(asked_key[q])] * len(best), key[found[best]].tolist(), score[best].tolist())
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "key": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return entries.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        search, "query bigint, key bigint, score double")


def nearest(
    vectors: DataFrame, is_query, k: int = 5, trees: int = 64, enough: int = 1000, share: float = 0.55,
    per_block: int = 16_000, per_part: int = 2_000, seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score (cosine): the k nearest found of each query, other rows than its own.

    ``vectors`` has vec_id and embedding; ``is_query`` makes a condition of a vec_id column. Ties go to the smaller
    vec_id; there are fewer than k rows if there are fewer vectors. Equal vectors are one entry of the index, so that
    a vector held by a third of all rows is one candidate. Runs jobs when called. An empty table gives no rows.

    The index is a forest per block of about ``per_block`` entries; the queries, in parts, visit every block. A query
    ascends until it has met ``enough`` entries and about ``share`` of the block. On vectors with clusters a small
    share does; on vectors without any (cosines of neighbours under 0.5) recall 0.9 needs one of this order.
    """
    rows = usable(vectors)
    asked = rows.where(is_query(F.col("vec_id"))).select("vec_id", "vec").distinct()
    asked = asked.withColumn("key", F.xxhash64(F.lit(1), F.transform("vec", lambda x: x + 0.0)))
    asked = store(asked.select(F.col("vec_id").alias("query_id"), "key"), "asked")
    classes = store(distinct_vectors(rows, k + 1), "vectors")
    wanted = classes.join(asked.select("key").distinct(), "key", "left_semi")
    wanted = store(wanted.select("key", "vec", "norm"), "queries")
    blocks = max(1, -(-classes.count() // per_block))
    parts = max(1, -(-asked.count() // per_part))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    entries = classes.select("key", "vec", "norm", F.col("ids")[0].alias("least"))
    entries = entries.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int")).withColumn("part", every(parts))
    wanted = wanted.withColumn("part", F.pmod("key", F.lit(parts)).cast("int")).withColumn("block", every(blocks))

    # k + 2 vectors hold the k least ids even among ties, whichever of them is the query's own
    found = searched(entries, wanted, k + 2, trees, enough, share, seed).join(classes.select("key", "ids"), "key")
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 2)
    rows = asked.join(found.select(F.col("query").alias("key"), "score", F.explode("ids").alias("vec_id")), "key")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = rows.where("vec_id <> query_id").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
