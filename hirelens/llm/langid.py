"""Nearest-centroid language identification over TF-IDF vectors of letter n-grams.

Texts become normalised TF-IDF vectors of hashed byte trigrams of their words. Document frequencies come from all
training documents. Each language gets several centroids by spherical k-means over a bounded sample of its documents.
The nearest centroid by cosine names the language; a text that is far from all centroids is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import long_column, slices, text_bytes

FEATURES = 1 << 13
FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x2C1B3C6D], np.uint32)
SLICE = 1 << 18  # bytes of text at a time: a worker needs some twenty bytes for each
HAS_LETTER = r"\p{L}"
# Classes of texts by their number of n-grams, and the bytes that training texts are also cut to, so that each is met.
CLASSES = np.array([32, 64, 128, 256, 1024])
CUTS = (30, 48, 96, 192, 512)


class Grams:
    """Feature numbers of all trigrams in a column of texts.

    Lower case (Latin, ASCII and its two-byte accented letters); every other ASCII byte is a blank. A trigram holds
    two letters at least, so that word beginnings and ends count and blanks alone do not.
    """

    def __init__(self):
        code = np.full(256, 32, np.uint32)
        code[65:91] = np.arange(97, 123)
        code[97:123] = np.arange(97, 123)
        code[128:] = np.arange(128, 256)
        self.code = code

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Feature at each byte, -1 for none, and the row ends."""
        offsets, data = text_bytes(texts)
        b = self.code[data]
        accented = np.zeros(len(b), bool)
        accented[1:] = data[:-1] == 0xC3
        b[accented & (b >= 0x80) & (b <= 0x9E)] += 0x20
        out = np.full(len(b), -1, np.int32)
        if len(b) > 2:
            letter = (b != 32).astype(np.int8)
            number = b[:-2] * FACTORS[0] + b[1:-1] * FACTORS[1] + b[2:] * FACTORS[2]  # modulo 2 ** 32
            number = ((number ^ (number >> 15)) * FACTORS[3]) >> 19
            out[:-2] = np.where(letter[:-2] + letter[1:-1] + letter[2:] >= 2, number.astype(np.int32), -1)
        edges = offsets[1:]
        for back in (1, 2):  # trigrams do not cross rows
            at = edges - back
            out[at[at >= 0]] = -1
        return out, offsets

    def counts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for part in slices([pa.record_batch([texts], ["text"])], "text", SLICE):
            features, offsets = self.features(part.column("text"))
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = features[a:b]
                yield np.bincount(own[own >= 0], minlength=FEATURES)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def weights(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and of those that hold each feature, over all rows of ``docs`` (column text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(), np.zeros(FEATURES + 1, np.int64)
        for batch in slices(batches, "text"):
            for row in grams.counts(batch.column("text")):
                held[:-1] += row > 0
                held[-1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(FEATURES + 1), pa.int64()), long_column(held)], ["feature", "held"])

    sums = docs.select("text").mapInArrow(count, "feature bigint, held bigint")
    found = sums.groupBy("feature").agg(F.sum("held")).collect()  # one row per feature: a fixed number
    held = np.zeros(FEATURES + 1, np.int64)
    for feature, n in found:
        held[feature] = n
    return int(held[-1]), held[:-1]


def clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean and then, again and again, the vector farthest from the centroids."""
    centroids = [unit(vectors.mean(axis=0))]
    nearest = vectors @ centroids[0]
    while len(centroids) < min(k, len(vectors)):
        centroids.append(vectors[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, vectors @ centroids[-1])
    centroids = np.array(centroids)
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, vectors)
        filled = np.linalg.norm(sums, axis=1) > 0
        new = np.where(filled[:, None], unit(sums), centroids)
        if np.allclose(new, centroids):
            break
        centroids = new
    return centroids


def floors(texts: list[str], idf: np.ndarray, centroids: np.ndarray, evidence: int, quantile: float,
           share: float, enough: int = 20) -> np.ndarray:
    """For each class of n-gram counts the cosine under which a text is too far from its language.

    It is ``share`` of a low quantile of the cosines that training texts (whole, and cut short) have with the nearest
    centroid of their own language. A class with less than ``enough`` of them takes the floor of shorter texts, which
    is the lower one as a rule; without any it is 0.
    """
    grams, sizes, own = Grams(), [], []
    for most in (*CUTS, None):
        cut = [t.encode()[:most].decode(errors="ignore") for t in texts]
        for counts in grams.counts(pa.array(cut, pa.string())):
            if counts.sum() >= evidence:
                sizes.append(counts.sum())
                own.append((centroids @ weights(counts, idf)).max())
    kind, own, out = np.searchsorted(CLASSES, sizes, "right"), np.array(own), np.zeros(len(CLASSES) + 1)
    for k in range(len(out)):
        held = own[kind == k] if len(own) else own
        out[k] = share * np.quantile(held, quantile) if len(held) >= enough else out[k - 1] if k else 0
    return out


def least_rows(rows: DataFrame, per_language: int) -> DataFrame:
    """The rows of each language that are least by order and mark, taken from the least of 64 parts, so that what
    meets in the one task of a language does not grow with the input."""
    first, whole = (Window.partitionBy("lang", *part).orderBy("order", "mark") for part in (["part"], []))
    parts = rows.withColumn("part", F.pmod(F.xxhash64("order", "mark", F.monotonically_increasing_id()), F.lit(64)))
    least = parts.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    least = least.withColumn("place", F.row_number().over(whole)).where(F.col("place") <= per_language)
    return least.drop("part", "place")


def fit(training: DataFrame, per_language: int = 600, k: int = 3, quantile: float = 0.01,
        share: float = 0.8, evidence: int = 12) -> dict:
    """A model from ``training`` (columns text, lang, order).

    Document frequencies cover all its rows. Centroids are clustered from at most ``per_language`` documents of each
    language, those least by ``order``; a row without text, letters or language teaches nothing. Languages are few
    (codes), so that their centroids are a small table. Each language gets floors of the cosine, see there. Ties in ``order`` (a bigint) go by a hash of the text. The model may be empty.
    """
    training = training.where(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER))
    n, held = document_frequencies(training)
    idf = np.log((1 + n) / (1 + held)) + 1
    training = training.select("lang", "text", F.col("order").cast("long").alias("order"), F.xxhash64("text").alias("mark"))
    # chosen on narrow rows; the texts of the others do not leave their tasks
    narrow = least_rows(training.select("lang", "order", "mark"), per_language)
    last = narrow.groupBy("lang").agg(F.max(F.struct("order", "mark")).alias("last")).collect()
    last = training.sparkSession.createDataFrame(
        [(r["lang"], *r["last"]) for r in last], "lang string, last_order long, last_mark long")
    near = training.join(last, "lang").where(F.struct("order", "mark") <= F.struct("last_order", "last_mark"))
    sample = least_rows(near, per_language)

    def learn(group: pa.Table) -> pa.Table:
        grams = Grams()
        texts = group.sort_by([("order", "ascending"), ("mark", "ascending")]).column("text").combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        rows = np.empty((len(texts), FEATURES), np.float32)
        for row, c in zip(rows, grams.counts(texts)):
            row[:] = np.log1p(c).astype(np.float32) * idf.astype(np.float32)
        centroids = clusters(unit(rows), k).astype(np.float64)
        least = floors(texts.to_pylist(), idf, centroids, evidence, quantile, share)
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(centroids)),
                         "centroid": pa.array(centroids.tolist(), pa.list_(pa.float64())),
                         "floors": pa.array([least.tolist()] * len(centroids), pa.list_(pa.float64()))})

    found = sample.select("lang", "text", "order", "mark").groupBy("lang").applyInArrow(
        learn, "lang string, centroid array<double>, floors array<double>")
    rows = sorted((r["lang"], r["centroid"], r["floors"]) for r in found.collect())
    return {"idf": idf, "langs": [r[0] for r in rows], "centroids": np.array([r[1] for r in rows]).reshape(-1, FEATURES),
            "floors": np.array([r[2] for r in rows]).reshape(-1, len(CLASSES) + 1)}


def predict(docs: DataFrame, model: dict, least: float = 0.02, evidence: int = 12) -> DataFrame:
    """``docs`` with lang_pred, score (the cosine, 0 to 1) and rejected.

    A null text and one without a letter is ``und``, scores 0 and is rejected. An empty model says ``und`` and rejects
    no other text.
    A text of at least ``evidence`` n-grams whose cosine with its nearest centroid is under the floor that fit() found for
    that language and length, or under ``least``, keeps that language as lang_pred and is rejected; a shorter text tells too little to be called far. Equal cosines go to the language that is
    first by name. Only ``text`` is read.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*kept)
    has_letter = F.coalesce(F.col("text").rlike(HAS_LETTER), F.lit(False))
    flagged = docs.withColumn("__letter", has_letter)
    langs, idf = model["langs"], model["idf"]
    # a cosine is (counts' weights . centroid) / length, and idf is folded into the centroids
    lowest = np.maximum(model["floors"], least)
    table = (model["centroids"] * idf).T.astype(np.float64) if langs else np.zeros((FEATURES, 0))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in slices(batches, "text"):
            scores, grams_seen = [], []
            for counts in grams.counts(batch.column("text")):
                at = np.flatnonzero(counts)
                grams_seen.append(counts.sum())
                tf = np.log1p(counts[at])
                length = np.sqrt(((tf * idf[at]) ** 2).sum())
                scores.append((tf @ table[at]) / length if length > 0 else np.zeros(len(langs)))
            scores = np.array(scores).reshape(batch.num_rows, len(langs))
            letter = batch.column("__letter").to_numpy(zero_copy_only=False).astype(bool)
            best = scores.argmax(axis=1) if langs else np.zeros(batch.num_rows, int)
            score = scores.max(axis=1).clip(0, 1) if langs else np.zeros(batch.num_rows)
            score = np.where(letter, score, 0.0)
            seen = np.array(grams_seen)
            under = score < lowest[best, np.searchsorted(CLASSES, seen, "right")] if langs else np.zeros(len(seen), bool)
            far = under & (seen >= evidence)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in kept],
                pa.array([langs[b] if ok and langs else "und" for b, ok in zip(best, letter)], pa.string()),
                pa.array(score, pa.float64()), pa.array(~letter | far, pa.bool_()),
            ], [*kept, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return flagged.mapInArrow(name, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
