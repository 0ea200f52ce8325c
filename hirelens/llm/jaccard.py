"""Exact n-gram Jaccard join with set relations: index blocks that are skipped by position, derived answers.

A document is the set of its distinct word shingles, as 64-bit hashes in ascending order. Equal sets are one class.

Index: the ordered set is cut into blocks by position (ranges of the hash space). Two sets whose sizes allow a link
differ in so few elements that, among one filled block more than that, one block at least agrees as a whole; so a set
sends that many of its filled blocks, in order of position, and no others. An index list holds the sets that share a
block; all other lists are skipped. Lists of single elements would grow with the square of the documents that share a
passage, and such documents may not be dropped; lists of blocks do not.

Answers: the sets that share a block with a leader (the least set of that block) are its family. Every member is
compared with the leader only; what is linked to it is connected. A family whose members are not all connected then elects
another leader, the member nearest to the first one: copies differ from each other by the edits of both and from their
original by their own alone, so the original or a set close to it is elected. Later leaders come from the members
outside the family's greatest component. A leader is compared with the members of other components; so a round has
no more rows than the families have members. What is open when rounds no longer pay is compared inside the tasks, sets
outside the greatest component with all others, in parts of bounded size; a task returns links that join components,
never pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import slices, store, text_bytes
from hirelens.llm.components import connected, joined

U64 = np.uint64
LEAST_BITS = 256
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Shingle hashes of a column of texts, vectorized over all bytes of a slice."""

    def __init__(self, words: int, seed: int = 0):
        self.words = words
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.blank = np.zeros(256, bool)
        self.blank[[32, *range(9, 14)]] = True
        self.codes = mix(lower.astype(np.uint64) + U64(1 + 1000 * seed))
        self.up = self.down = np.ones(1, np.uint64)

    def _word_hashes(self, data: np.ndarray, starts_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word; starts_doc marks bytes at which a document begins."""
        n = len(data)
        if len(self.up) < n + 1:
            self.up = _powers(int(_BASE), n + 1)
            self.down = _powers(pow(int(_BASE), -1, 1 << 64), n + 1)
        solid = ~self.blank[data]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = solid[:-1]
        first = solid & (~before | starts_doc)
        last = np.empty(n, bool)
        last[-1] = solid[-1]
        last[:-1] = solid[:-1] & (~solid[1:] | starts_doc[1:])
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[:n], out=sums[1:])
        return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64)), begin

    def hashes(self, texts: pa.Array, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every distinct shingle, ordered by row and hash."""
        offsets, data = text_bytes(texts)
        marks = np.zeros(len(data) + 1, bool)
        marks[offsets[:-1]] = True
        words, at, low = [], [], 0
        while low < len(data):  # a text may be longer than a part: parts end at a blank
            high = min(len(data), low + part)
            while high < len(data) and not (self.blank[data[high]] or marks[high]):
                high += 1
            found, begin = self._word_hashes(data[low:high], marks[low:high])
            words.append(found)
            at.append(begin + low)
            low = high
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        word, where = np.concatenate(words), np.concatenate(at)
        row = np.searchsorted(offsets, where, "right") - 1
        count = np.bincount(row, minlength=len(texts))
        k, fold = self.words, U64(0x9DDFEA08EB382D69)
        rows, hashes = [], []
        if len(word) >= k:
            h = word[:len(word) - k + 1].copy()
            for j in range(1, k):
                h = h * fold + word[j:len(word) - k + 1 + j]
            whole = row[:len(word) - k + 1] == row[k - 1:]
            rows.append(row[:len(word) - k + 1][whole])
            hashes.append(mix(h[whole]))
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            begin = np.searchsorted(row, short)
            h = word[begin].copy()
            for j in range(1, k - 1):
                more = count[short] > j
                h[more] = h[more] * fold + word[begin[more] + j]
            rows.append(short)
            hashes.append(mix(h + count[short].astype(np.uint64)))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        row, h = np.concatenate(rows), np.concatenate(hashes)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        return row[new], h[new]


class Law:
    """The threshold percent / 100 as whole-number bounds, and the size intervals of the index."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        self.lows, self.blocks = [], []
        low = 1
        while low <= largest:
            high = self.partner(self.partner(low))
            differ = self.differ(high + self.partner(high))
            self.lows.append(low)
            self.blocks.append(differ + 3 + differ // 25 if differ else 0)  # some of them are empty
            low = high + 1
        self.lows, self.blocks = map(np.array, (self.lows, self.blocks))

    def partner(self, size):
        """Size of the largest set that can be linked with one of that size."""
        return 100 * size // self.percent

    def differ(self, sizes):
        """Most elements in which linked sets with that sum of sizes can differ."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def linked(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)


def sketch_bits(sizes: np.ndarray) -> np.ndarray:
    """Bits of an odd sketch: the power of two at or over the size of the set, so that long sets do not fill it."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(sizes, LEAST_BITS))).astype(np.int64))


def odd_sketches(row: np.ndarray, h: np.ndarray, sizes: np.ndarray, fine: int = 1) -> list[bytes]:
    """Odd sketches of sets given as (row, hash); ``fine`` times as many bits tell close sets apart better."""
    width = sketch_bits(fine * sizes)
    first = np.cumsum(width) - width
    place = ((h >> U64(7)) & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits(np.bincount(first[row] + place, minlength=int(width.sum())).astype(np.uint8) & 1)
    cuts = np.concatenate([first, [width.sum()]]) // 8
    return [bits[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])]


def set_rows(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """Size, digest and odd sketch of every document's shingle set, with all columns of ``docs`` but the text."""
    carried = [c for c in docs.columns if c != "text"]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carried)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, seed)
        for batch in slices(batches, "text"):
            n = batch.num_rows
            row, h = shingler.hashes(batch.column("text"))
            ends = np.searchsorted(row, np.arange(n + 1))
            digest = [int.from_bytes(hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest(), "little")
                      for a, b in zip(ends[:-1], ends[1:])]
            half = lambda shift: pa.array(
                np.array([(d >> shift) & (2**64 - 1) for d in digest], np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in carried], pa.array(np.diff(ends), pa.int64()), half(0), half(64),
                pa.array(odd_sketches(row, h, np.diff(ends)), pa.binary()),
            ], [*carried, "n", "key", "key2", "sketch"])

    return docs.mapInArrow(describe, f"{kinds}n bigint, key bigint, key2 bigint, sketch binary")


def block_rows(docs: DataFrame, words: int, seed: int, law: Law, remember: int = 500_000) -> DataFrame:
    """The index: block and key of every set, with the blocks of its own size interval and, where a set there may be
    linked with it, of the one below.

    A set sends its first filled blocks, one more than the elements in which it can differ from a linked set: of two
    linked sets, one sends no further than the other, and the blocks that it sends cannot all disagree. A set with too
    few filled blocks sends all blocks, also the empty ones. A task sends a set once, as far as it remembers (a repeated
    row changes nothing).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sent = Shingler(words, seed), set()
        for batch in slices(batches, "text"):
            n = batch.num_rows
            row, h = shingler.hashes(batch.column("text"))
            ends = np.searchsorted(row, np.arange(n + 1))
            key = np.array([int.from_bytes(hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest()[:8], "little")
                            for a, b in zip(ends[:-1], ends[1:])], np.uint64).view(np.int64)
            size = np.diff(ends)
            fresh = np.zeros(n, bool)
            for i, k in enumerate(key.tolist()):
                if size[i] and k not in sent:
                    if len(sent) >= remember:
                        sent.clear()
                    sent.add(k)
                    fresh[i] = True
            interval = np.searchsorted(law.lows, size, "right") - 1
            inner = mix(h ^ U64(0x5851F42D4C957F2D))
            for below in (0, 1):
                scheme = interval - below
                partner = law.lows[np.maximum(interval, 0)] - 1 if below else law.partner(size)
                needed = law.differ(size + partner) + 1
                meets = fresh & (scheme >= 0) & (100 * partner >= law.percent * size)
                blocks = np.where(meets, law.blocks[np.maximum(scheme, 0)], 0)
                kept = blocks[row] > 0
                if not kept.any():
                    continue
                r, content = row[kept], inner[kept]
                block = ((h[kept] >> U64(32)) * blocks[r].astype(np.uint64)) >> U64(32)
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (block[1:] != block[:-1])
                at = np.flatnonzero(new)
                place = lambda rows, b: mix(scheme[rows].astype(np.uint64) * U64(1 << 40) + b)
                sign = mix(np.add.reduceat(content, at) ^ place(r[at], block[at]))
                filled = np.bincount(r[at], minlength=n)
                sends = np.arange(len(at)) - (np.cumsum(filled) - filled)[r[at]] < needed[r[at]]
                sign, keys = sign[sends], key[r[at]][sends]
                for i in np.flatnonzero((blocks > 0) & (filled < needed)):
                    none = np.setdiff1d(np.arange(blocks[i], dtype=np.uint64), block[at][r[at] == i])
                    sign = np.append(sign, mix(place(np.full(len(none), i), none)))
                    keys = np.append(keys, np.full(len(none), key[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sign.view(np.int64), pa.int64()), pa.array(keys, pa.int64())], ["block", "key"])

    return docs.select("text").mapInArrow(cut, "block bigint, key bigint")


def _folded(sketches: np.ndarray, wide: int) -> np.ndarray:
    """Rows of sketches at a width of ``wide`` bytes: a half of the bits is the other half's odd sum."""
    while sketches.shape[1] > wide:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _ones(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Bits in which two columns of sketches differ: a lower bound of the elements in which the sets differ."""
    a, b = a.to_pylist(), b.to_pylist()
    wide = np.array([(len(x), len(y)) for x, y in zip(a, b)])
    out = np.zeros(len(a), np.int64)
    for wa, wb in np.unique(wide, axis=0):
        at = np.flatnonzero((wide == (wa, wb)).all(axis=1))
        x, y = (_folded(np.frombuffer(b"".join([z[i] for i in at]), np.uint8).reshape(len(at), -1), min(wa, wb))
                for z in (a, b))
        out[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def may_be(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows with ``__may``: whether their 64-bit ``__mark`` may be one of ``wanted``, so that the others need not be sent.

    A bit for each value of 25 bits of a mark tells; they travel as 2^19 numbers at most. No wanted row is told no.
    """
    word, bit = F.shiftrightunsigned("__mark", 45), F.expr("shiftleft(1L, cast(__mark & 63 as int))")
    bits = wanted.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    found = rows.withColumn("__word", word).join(F.broadcast(bits), "__word", "left")
    may = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return found.select(*rows.columns, may.alias("__may"))


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``__mark`` may be one of ``wanted``."""
    return may_be(rows, wanted).where("__may").select(*rows.columns)


def texts_of(keys: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """key and a text of each class. Id and hash find one; where rows share both, one of them is taken."""
    needed = keys.join(classes.select("key", F.col("doc_id").alias("__id"), F.col("hash").alias("__own")), "key")
    needed = store(needed, "needed")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__hash"))
    rows = marked(rows.withColumn("__mark", F.xxhash64("doc_id", "__hash")),
                  needed.select(F.xxhash64("__id", "__own").alias("__mark")))
    texts = rows.join(needed, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__own")))
    return texts.select("key", "text").dropDuplicates(["key"])


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, seed: int, law: Law) -> DataFrame:
    """Pairs (a, b) with ``linked`` and bounds ``low`` and ``high`` of their Jaccard distance.

    Pairs that sizes and sketches allow are compared as whole sets: their bounds are equal. The others are not linked,
    and what they differ in by size or sketch bounds their distance from below. Texts instead of sets travel to a pair,
    as they are smaller.
    """
    facts = classes.select("key", "n", "sketch")
    both = pairs.join(facts.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    both = both.join(facts.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")

    def allow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            differ = np.maximum(_ones(batch.column("sa"), batch.column("sb")), np.abs(na - nb))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(differ <= law.differ(na + nb)),
                 pa.array(2 * differ / (na + nb + differ))], ["a", "b", "near", "low"])

    judged = store(both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        allow, "a bigint, b bigint, near boolean, low double"), "judged")
    near = judged.where("near").select("a", "b")
    needed = near.select(F.col("a").alias("key")).union(near.select(F.col("b").alias("key"))).distinct()
    texts = store(texts_of(needed, classes, docs), "texts")
    both = near.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")
    both = both.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, seed)
        leader, x = None, np.zeros(0, np.uint64)
        for batch in slices(batches, "tb"):
            linked, distance = [], []
            row, h = shingler.hashes(batch.column("tb"))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != leader:  # rows of one leader come one after the other
                    leader, x = a, shingler.hashes(batch.column("ta").slice(i, 1))[1]
                y = h[ends[i]:ends[i + 1]]
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                linked.append(law.linked(common, len(x), len(y)))
                distance.append(1 - common / (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(distance, pa.float64()),
                 pa.array(distance, pa.float64())], ["a", "b", "linked", "low", "high"])

    exact = both.select("a", "b", "ta", "tb").mapInArrow(
        compare, "a bigint, b bigint, linked boolean, low double, high double")
    far = judged.where("not near").select("a", "b", F.lit(False).alias("linked"), "low", F.lit(1.0).alias("high"))
    return store(exact.union(far), "verified")


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (list, key, low) of families that are not one component, with ``label`` and whether it is the ``main`` one."""
    rows = members.join(labels.select(F.col("node").alias("key"), "label"), "key", "left")
    rows = rows.withColumn("label", F.coalesce("label", "key"))
    parts = rows.groupBy("list", "label").agg(F.count("*").alias("n")).groupBy("list").agg(
        F.count("*").alias("parts"), F.max(F.struct("n", "label"))["label"].alias("main"))
    rows = rows.join(parts.where("parts > 1").select("list", "main"), "list")
    return rows.select("list", "key", "low", "label", (F.col("label") == F.col("main")).alias("main"))


def elected(rows: DataFrame, turn: int) -> DataFrame:
    """The next leader of each family of ``open_members``: list, leader, its_label.

    First the member nearest to the least set, then one outside the greatest component.
    """
    rank = F.struct(F.col("low") if turn == 0 else F.lit(0.0), F.xxhash64(F.lit(turn), "key"))
    candidates = rows if turn == 0 else rows.where("not main")
    return candidates.groupBy("list").agg(
        F.min_by(F.struct("key", "label"), rank).alias("pick")).select(
        "list", F.col("pick.key").alias("leader"), F.col("pick.label").alias("its_label"))


def set_bytes(texts: DataFrame, words: int, seed: int) -> DataFrame:
    """key, n and the shingle hashes of each text, in order, as bytes."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, seed)
        for batch in slices(batches, "text"):
            row, h = shingler.hashes(batch.column("text"))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), pa.array(np.diff(ends), pa.int64()),
                pa.array([h[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary())], ["key", "n", "hashes"])

    return texts.select("key", "text").mapInArrow(describe, "key bigint, n bigint, hashes binary")


def spread(rows: DataFrame, size: Column, part_bytes: int) -> DataFrame:
    """Open members dealt to parts p, q of their family, both of about ``part_bytes``: those outside the greatest
    component (``asked``) to a p and every q, all of them to a q and every p."""
    parts = rows.groupBy("list").agg(
        F.ceil(F.sum(size) / part_bytes).cast("int").alias("parts"),
        F.ceil(F.sum(F.when(~F.col("main"), size)) / part_bytes).cast("int").alias("outer"))
    rows = rows.join(parts, "list").withColumn("hash", F.xxhash64(F.lit(5), "key"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod("hash", F.col(n)).cast("int")
    columns = ["list", "p", "q", "asked", "key", "label", "n"]
    rows = rows.where("outer > 0")
    inner = rows.withColumns({"asked": F.lit(False), "q": part("parts")}).withColumn("p", every("outer")).select(*columns)
    asked = rows.where("not main").withColumns({"asked": F.lit(True), "p": part("outer")})
    return inner.union(asked.withColumn("q", every("parts")).select(*columns))


class Family:
    """A part of a family inside a task, told by sizes and sketches of its members."""

    def __init__(self, group: pa.Table, n: np.ndarray, sketches: list[bytes], law: Law):
        self.key, label = group.column("key").to_numpy(), group.column("label").to_numpy()
        asked = np.array(group.column("asked").to_pylist(), bool)
        self.asked, inner = np.flatnonzero(asked), np.flatnonzero(~asked)
        self.component = np.unique(label, return_inverse=True)[1]
        self.n, self.raw, self.law = n, sketches, law
        wide = np.array([len(x) for x in sketches])
        self.at = {w: inner[wide[inner] == w] for w in np.unique(wide[inner])}
        self.folded = {(w, w): np.frombuffer(b"".join([sketches[i] for i in at]), np.uint8).reshape(len(at), w)
                       for w, at in self.at.items()}

    def near(self, i: int) -> Iterator[int]:
        """Members of other components that sizes and sketches let be linked with i, nearest first."""
        own, n = np.frombuffer(self.raw[i], np.uint8).reshape(1, -1), self.n
        for w, at in self.at.items():
            found = at[(self.component[at] != self.component[i]) & (
                100 * np.minimum(n[at], n[i]) >= self.law.percent * np.maximum(n[at], n[i]))]
            if not len(found):
                continue
            to = min(w, own.shape[1])
            if (w, to) not in self.folded:
                self.folded[w, to] = _folded(self.folded[w, w], to)
            rows = self.folded[w, to][np.searchsorted(at, found)]
            differ = np.bitwise_count(rows ^ _folded(own, to)).sum(axis=1, dtype=np.int64)
            may = differ <= self.law.differ(n[found] + n[i])
            yield from found[may][np.argsort(differ[may], kind="stable")].tolist()


def joining_links(
    rows: DataFrame, classes: DataFrame, docs: DataFrame, words: int, seed: int, law: Law, part_bytes: int = 32 << 20,
) -> DataFrame:
    """Links (a, b) that join the components of each family of ``open_members`` as far as its sets are linked.

    Members outside a family's greatest component meet all members, in parts of bounded size, twice: first as
    sketches, which leaves the members that have anyone to be linked with; then those as sets. Only the first link
    found between two components is returned.
    """
    rows = rows.join(classes.select("key", "n"), "key").select("list", "key", "label", "main", "n")

    def sketched(group: pa.Table) -> pa.Table:
        family = Family(group, group.column("n").to_numpy(), group.column("sketch").to_pylist(), law)
        found = np.zeros(group.num_rows, bool)
        for i in family.asked:
            others = list(family.near(i))
            found[others] = True
            found[i] |= bool(others)
        keys = np.unique(family.key[found])
        return pa.table({"list": pa.array(np.full(len(keys), group.column("list")[0].as_py()), pa.int64()),
                         "key": pa.array(keys, pa.int64())})

    told = spread(rows, F.greatest(F.col("n") / 4, F.lit(32)) + 64, part_bytes)
    told = told.join(classes.select("key", "sketch"), "key").repartition("list", "p", "q")
    near = told.groupBy("list", "p", "q").applyInArrow(sketched, "list bigint, key bigint")
    near = store(near.distinct(), "near")
    sets = set_bytes(texts_of(near.select("key").distinct(), classes, docs), words, seed)
    sets = store(sets.select("key", "hashes"), "sets")

    def compare(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
        n = np.array([len(x) for x in sets])
        sketches = odd_sketches(np.repeat(np.arange(len(sets)), n), np.concatenate(sets), n, fine=4)
        family, links = Family(group, n, sketches, law), []
        component = family.component
        for i in family.asked:
            for j in family.near(i):
                if component[j] == component[i]:
                    continue
                place = np.searchsorted(sets[j], sets[i])
                common = int((sets[j][np.minimum(place, n[j] - 1)] == sets[i]).sum())
                if law.linked(common, n[i], n[j]):
                    links.append((family.key[i], family.key[j]))
                    component[component == component[j]] = component[i]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    both = spread(rows.join(near, ["list", "key"], "left_semi"), 8 * F.col("n") + 64, part_bytes)
    both = both.join(sets, "key").repartition("list", "p", "q")
    return both.groupBy("list", "p", "q").applyInArrow(compare, "a bigint, b bigint")


def similar_components(
    docs: DataFrame, words: int = 5, percent: int = 80, carry: tuple[str, ...] = (), label: str | None = None,
    rounds: int = 8, many: int = 50_000,
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row of ``docs``.

    Columns named by ``carry`` are kept too; ``label`` names a column for the component itself (null for empty sets),
    which tells components apart whatever their ids are.

    Words are runs without ASCII blanks, A-Z lower-cased. A text of fewer than ``words`` words is one shingle; a null
    or blank text is empty, linked with nothing, its own component. Equal texts are one class whatever their number.
    Only doc_id and text are read, so other columns may have any name; texts of any length are read in parts; an empty
    table gives no rows. ``docs`` should be a stored table. Runs several jobs when called. A null doc_id is
    the component's only if it has no other. Leaders are elected, ``rounds`` times at most, while more than ``many``
    members are open and a round closes a quarter of them; what is open then is compared inside tasks. Neither number
    changes the result.
    """
    law = Law(percent)
    docs = docs.select("doc_id", "text", *carry)
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    for seed in range(8):
        facts = store(set_rows(hashed, words, seed), "facts")
        classes = facts.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.coalesce(F.min_by("__hash", "doc_id"), F.min("__hash")).alias("hash"),
            (F.min("key2") != F.max("key2")).alias("clash"))
        classes = store(classes, "classes")
        if classes.where("clash").isEmpty():
            break  # else two different sets got one key: draw other hashes
    else:
        raise RuntimeError("different sets share a 64-bit key under eight hashes")
    index = block_rows(docs, words, seed, law)
    leader = F.min("key").over(Window.partitionBy("block"))
    lists = index.withColumn("leader", leader).where("leader < key")
    stars = store(lists.select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct(), "stars")

    first = verified(stars, classes, docs, words, seed, law)
    members = first.select(F.col("a").alias("list"), F.col("b").alias("key"), "low")
    labels = connected(first.where("linked").select("a", "b"))
    rows = store(open_members(members, labels), "members")
    still = rows.count()
    for turn in range(rounds):
        if still <= many:
            break
        led = rows.join(elected(rows, turn), "list").where("key <> leader")
        pairs = store(led.where("label <> its_label").select(
            F.col("leader").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
        labels = joined(labels, verified(pairs, classes, docs, words, seed, law).where("linked").select("a", "b"))
        rows = store(open_members(led.select("list", "key", "low"), labels), "members")
        before, still = still, rows.count()
        if still > 0.75 * before:
            break
    if still:
        labels = joined(labels, store(joining_links(rows, classes, docs, words, seed, law), "links"))

    named = labels.withColumnRenamed("node", "key").join(classes.select("key", "doc_id"), "key")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "label").select("key", "label", "component_id")
    own = classes.select("key", F.col("doc_id").alias("own_id")).join(named, "key", "left")
    own = own.select("key", F.coalesce("label", "key").alias("__label"), F.when(
        F.col("label").isNull(), F.col("own_id")).otherwise(F.col("component_id")).alias("component_id"))
    out = facts.join(own, "key", "left")
    return out.select(
        "doc_id", *carry, F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *([F.when(F.col("n") > 0, F.col("__label")).alias(label)] if label else []))
