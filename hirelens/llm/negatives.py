"""Hard negatives by angular triangle filtering: exact integer scores where angle intervals leave a chance.

Every vector keeps its norm and its angles to a few reference directions. For two vectors with angles a and t to one
reference the triangle inequality on the sphere puts their own angle into [|a - t|, min(a + t, 2 pi - a - t)]; over all
references the intervals are intersected. The cosines of the ends, times the norms and widened for rounding, bound the
integer score from both sides.

Rows lie in tiles, in each sorted by label, nearest reference and angle, and cut into windows of neighbours. An anchor
is scored against a window only if the window's bounds overlap the scores still asked for: those over the anchor's
fifth-best positive so far, or those inside a positive's range of negative scores and over its tenth best so far. The
anchors (a stated query set) meet all tiles, tile by tile; what a tile returns has a fixed size per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import store

MARGIN = 2e-6  # radians; covers single-precision angles and the rounding of arccos
LONG = np.iinfo(np.int64)
NONE = LONG.min  # the score of an empty place
KINDS = [np.int16, np.int32, np.int64, np.float64]


def packed(whole: np.ndarray) -> bytes:
    """Whole numbers (in doubles) in the narrowest of four kinds, its number in front."""
    top = np.abs(whole).max(initial=0)
    kind = 0 if top < 2 ** 15 else 1 if top < 2 ** 31 else 2 if top < 2 ** 62 else 3
    return bytes([kind]) + whole.astype(KINDS[kind]).tobytes()


def unpacked(cells: list[bytes]) -> np.ndarray:
    """A matrix of doubles; shorter vectors end in zeros."""
    rows = [np.frombuffer(c, KINDS[c[0]], offset=1) for c in cells]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all of b; beyond a long, the nearest long."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if not d:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * d < 2 ** 53:  # every partial sum is exact in doubles
        return (a @ b.T).astype(np.int64)
    x, y = (np.array([[int(v) for v in row] for row in m], object).reshape(len(m), d) for m in (a, b))
    return np.clip(x @ y.T, int(NONE) + 1, int(LONG.max)).astype(np.int64)


def angles(q: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the (unit) references; a zero vector has a right angle to all."""
    top = np.abs(q).max(axis=1, initial=0, keepdims=True)
    unit = q / np.where(top > 0, top, 1)
    size = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit / np.where(size > 0, size, 1)
    d = min(q.shape[1], references.shape[1])
    cosine = unit[:, :d] @ references[:, :d].T
    return (size * top)[:, 0], np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (bigint) and embedding (doubles) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def reference_directions(rows: DataFrame, n: int, sample: int = 512) -> np.ndarray:
    """Unit vectors, each far from those before it, out of the ``sample`` rows of least hash. Only pruning uses them."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    width = max((len(r.embedding) for r in drawn), default=0)
    unit = np.zeros((len(drawn), width))
    for i, r in enumerate(drawn):
        v = np.array(r.embedding, float)
        v = v / max(np.abs(v).max(initial=0), 1e-300)
        unit[i, :len(v)] = v / max(np.linalg.norm(v), 1e-300)
    unit = unit[np.linalg.norm(unit, axis=1) > 0.5]
    if not len(unit):
        return np.zeros((0, width))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def described(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """vec_id, label, q (floor(256 x) of every component, packed), norm, angles and key (one per different row)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [packed(np.floor(256 * np.array(v, float))) for v in batch.column("embedding").to_pylist()]
            norm, angle = angles(unpacked(cells), references)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(cells, pa.binary()), pa.array(norm),
                 pa.array([a.tobytes() for a in angle], pa.binary())], ["vec_id", "label", "q", "norm", "angles"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    out = rows.mapInArrow(describe, f"vec_id {kind}, label bigint, q binary, norm double, angles binary")
    return out.withColumn("key", F.xxhash64("vec_id", "label", "q"))


class Tile:
    """Rows in windows of neighbours with one label, each with the ranges of its angles and norms."""

    def __init__(self, rows: pa.Table, window: int):
        ids, key = rows.column("vec_id").to_numpy(), rows.column("key").to_numpy()
        once = np.unique(key, return_index=True)[1]  # repeated rows count once
        rows, ids = rows.take(pa.array(once)), ids[once]
        label, self.norm = rows.column("label").to_numpy(), rows.column("norm").to_numpy()
        angle = np.array([np.frombuffer(a, np.float32) for a in rows.column("angles").to_pylist()])
        angle = angle.reshape(len(ids), -1).astype(float)
        if angle.shape[1]:
            near = angle.argmin(axis=1)
            order = np.lexsort((ids, angle[np.arange(len(ids)), near], near, label))
        else:
            order = np.lexsort((ids, label))
        self.ids, self.label, self.norm = ids[order], label[order], self.norm[order]
        cells = rows.column("q").to_pylist()
        self.q = unpacked([cells[i] for i in order])
        angle = angle[order]
        new = np.flatnonzero(np.append(True, self.label[1:] != self.label[:-1]))
        self.cuts = [(a, min(a + window, b)) for x, b in zip(new, [*new[1:], len(ids)]) for a in range(x, b, window)]
        starts = [a for a, _ in self.cuts]
        fold = lambda f, x: f.reduceat(x, starts, axis=0)
        self.low, self.high = fold(np.minimum, angle), fold(np.maximum, angle)
        self.least, self.most = fold(np.minimum, self.norm), fold(np.maximum, self.norm)
        self.window_label = self.label[starts]

    def bounds(self, norm: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that any row of each window (columns) can have with each anchor (rows)."""
        near, far = np.zeros((len(norm), len(self.cuts))), np.full((len(norm), len(self.cuts)), math.pi)
        for r in range(self.low.shape[1]):
            a, low, high = angle[:, r:r + 1], self.low[:, r], self.high[:, r]
            near = np.maximum(near, np.maximum(low - a, a - high))
            top = np.where((a + low <= math.pi) & (a + high >= math.pi), math.pi,
                           np.maximum(np.minimum(a + low, 2 * math.pi - a - low),
                                      np.minimum(a + high, 2 * math.pi - a - high)))
            far = np.minimum(far, top)
        upper, lower = np.cos(np.maximum(near - MARGIN, 0)), np.cos(np.minimum(far + MARGIN, math.pi))
        size = norm[:, None]
        slack = 1 + 1e-9 * size * self.most
        return (size * np.where(lower >= 0, self.least, self.most) * lower - slack,
                size * np.where(upper >= 0, self.most, self.least) * upper + slack)


def merged(score: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best places of each row after more scores: highest first, ties by smaller id."""
    k = score.shape[1]
    every = np.concatenate([score, more], axis=1)
    every_ids = np.concatenate([ids, np.broadcast_to(more_ids, more.shape)], axis=1)
    order = np.lexsort((every_ids, -np.maximum(every, NONE + 1)), axis=1)[:, :k]
    return np.take_along_axis(every, order, 1), np.take_along_axis(every_ids, order, 1)


class Anchors:
    def __init__(self, rows: pa.Table):
        self.key, self.ids = rows.column("key").to_numpy(), rows.column("vec_id").to_numpy()
        self.label, self.norm = rows.column("label").to_numpy(), rows.column("norm").to_numpy()
        self.q = unpacked(rows.column("q").to_pylist())
        angle = np.array([np.frombuffer(a, np.float32) for a in rows.column("angles").to_pylist()])
        self.angle = angle.reshape(len(self.ids), -1).astype(float)


def best_positives(tile: Tile, anchors: Anchors, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of anchor, place (0), id and score: each anchor's best k other rows of its label in the tile."""
    best = np.full((len(anchors.ids), k), NONE)
    best_ids = np.full((len(anchors.ids), k), LONG.max)
    _, upper = tile.bounds(anchors.norm, anchors.angle)
    for w in np.argsort(-upper.max(axis=0), kind="stable"):
        a, b = tile.cuts[w]
        asked = np.flatnonzero((anchors.label == tile.window_label[w]) & (upper[:, w] >= best[:, -1]))
        if not len(asked):
            continue
        found = scores(anchors.q[asked], tile.q[a:b])
        found[anchors.ids[asked][:, None] == tile.ids[a:b]] = NONE
        better = found.max(axis=1) >= best[asked, -1]
        asked, found = asked[better], found[better]
        best[asked], best_ids[asked] = merged(best[asked], best_ids[asked], found, tile.ids[a:b])
    at, place = np.nonzero(best > NONE)
    yield at, np.zeros(len(at), np.int64), best_ids[at, place], best[at, place]


def best_negatives(tile: Tile, anchors: Anchors, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of anchor, positive's place, id and score: per positive the best k rows of other labels in its range."""
    n, places = low.shape
    best = np.full((n, places, k), NONE)
    best_ids = np.full((n, places, k), LONG.max)
    lower, upper = tile.bounds(anchors.norm, anchors.angle)
    for w in np.argsort(-upper.max(axis=0), kind="stable"):
        a, b = tile.cuts[w]
        least = np.maximum(low, best[:, :, -1])
        over = ((upper[:, w, None] >= least) & (lower[:, w, None] <= high) & (least <= high)).any(axis=1)
        asked = np.flatnonzero((anchors.label != tile.window_label[w]) & over)
        if not len(asked):
            continue
        found = scores(anchors.q[asked], tile.q[a:b])
        for j in range(places):
            inside = (found >= least[asked, j, None]) & (found <= high[asked, j, None])
            rows = inside.any(axis=1)
            to = asked[rows]
            best[to, j], best_ids[to, j] = merged(
                best[to, j], best_ids[to, j], np.where(inside[rows], found[rows], NONE), tile.ids[a:b])
    at, place, rank = np.nonzero(best > NONE)
    yield at, place, best_ids[at, place, rank], best[at, place, rank]


def searched(entries: DataFrame, anchors: DataFrame, window: int, search: Callable) -> DataFrame:
    """key, place, id and score of what ``search`` (tile, anchors, table of anchors) finds in each tile and part."""

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 4]
        if rows.num_rows and asked.num_rows:
            tile = Tile(rows, window)
            for at in range(0, asked.num_rows, 1024):
                some = asked.slice(at, 1024).combine_chunks()
                chunk = Anchors(some)
                out += [(chunk.key[a], place, ids, score) for a, place, ids, score in search(tile, chunk, some)]
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
        return pa.table(dict(zip(("key", "place", "id", "score"), map(pa.array, columns))))

    return entries.groupBy("tile", "part").cogroup(anchors.groupBy("tile", "part")).applyInArrow(
        run, "key bigint, place bigint, id bigint, score bigint")


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def scaled(score: Column, tenths: int, up: bool) -> Column:
    """score * tenths / 10 rounded up or down, exactly."""
    exact = score.cast("decimal(20,0)") * F.lit(Decimal(tenths) / 10)
    return (F.ceil(exact) if up else F.floor(exact)).cast("bigint")


def hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 10,
    low_tenths: int = 3, high_tenths: int = 9, references: int = 16, per_tile: int = 8192, per_part: int = 16384,
    window: int = 64,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` makes a condition of a vec_id column. A score is the
    integer inner product of floor(256 * x); higher scores first, ties by smaller vec_id. The positives of an anchor
    are its best ``positives`` rows of the same label with another vec_id; the negatives of a positive are the best
    ``negatives`` rows of other labels whose scores lie between ``low_tenths`` and ``high_tenths`` tenths of its own.
    Fewer rows give all of them; a negative positive score has an empty range.

    Rows with a null vec_id, label or vector, or a component that is null or not finite (256 times it included) take no
    part. Rows equal in id, label and integer vector count once; rows with one vec_id but other contents are rows of
    their own. Shorter vectors count as ended by zeros, vectors without components score 0, scores beyond a long count
    as the nearest long. Only the three columns are read; an empty table gives no rows. Runs jobs when called.

    Tiles hold about ``per_tile`` rows, parts about ``per_part`` anchors: the memory of a task. The square root of all
    tiles is searched first, which gives every range a score to beat in the other tiles.
    """
    usable_rows = usable(vectors)
    directions = reference_directions(usable_rows, references)
    rows = store(described(usable_rows, directions), "vectors")
    tiles = max(1, -(-rows.count() // per_tile))
    asked = store(rows.where(is_anchor(F.col("vec_id"))).dropDuplicates(["key"]), "anchors")
    parts = max(1, -(-asked.count() // per_part))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    entries = rows.withColumn("tile", F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(tiles)).cast("int"))
    entries = entries.withColumn("part", every(parts))
    wanted = asked.withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))
    everywhere = wanted.withColumn("tile", every(tiles))

    found = searched(entries, everywhere, window, lambda tile, anchors, _: best_positives(tile, anchors, positives))
    best = store(top(found, positives).drop("place"), "positives")
    score = F.col("score")
    ranges = best.withColumn("low", scaled(score, low_tenths, True)).withColumn("high", scaled(score, high_tenths, False))
    ranges = ranges.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("ranges"))
    ranged = store(wanted.join(ranges, "key"), "ranges")

    def negatives_of(tile: Tile, anchors: Anchors, table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        told = table.column("ranges").to_pylist()
        low, high = np.full((len(told), positives), 1), np.full((len(told), positives), 0)  # empty
        for i, some in enumerate(told):
            for r in some:
                low[i, r["rank"] - 1], high[i, r["rank"] - 1] = r["low"], r["high"]
        return best_negatives(tile, anchors, low, high, negatives)

    first = math.isqrt(tiles - 1) + 1
    seen = searched(entries.where(F.col("tile") < first), ranged.withColumn("tile", every(first)), window, negatives_of)
    seen = store(top(seen, negatives), "seen").drop("rank")
    if first < tiles:
        beat = seen.groupBy("key", "place").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        beat = beat.where(F.col("n") == negatives).groupBy("key").agg(
            F.map_from_entries(F.collect_list(F.struct(F.col("place") + 1, "least"))).alias("beat"))
        raised = F.transform("ranges", lambda r: r.withField("low", F.greatest(r["low"], F.try_element_at(
            F.col("beat"), r["rank"].cast("bigint")))))
        rest = ranged.join(beat, "key", "left").withColumn("ranges", raised).drop("beat")
        rest = rest.withColumn("tile", F.explode(F.sequence(F.lit(first), F.lit(tiles - 1))))
        seen = seen.union(searched(entries.where(F.col("tile") >= first), rest, window, negatives_of))
    chosen = top(seen, negatives).withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
    named = best.select("key", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    named = named.join(asked.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return chosen.join(named, ["key", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_force_sql() -> str:
    """The contract's rows in SQL: every anchor against all rows."""
    return """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF isfinite(x::DOUBLE)]) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (
         PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""
