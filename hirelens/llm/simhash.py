"""Near duplicates by SimHash: fingerprints that share blocks of bits are joined and verified by Hamming distance.

Fingerprint: a bit is 1 if it is set in over half of the hashes of the text's word shingles, repeats included.

Links (pigeonhole): the 64 bits are cut into four blocks, so fingerprints that differ in two bits at most
agree on two blocks at least. Every pair of blocks is one key; fingerprints with a key in common are compared. Equal
fingerprints are one entry beforehand, so copies never meet in a join.

A key that many different fingerprints share would make pairs in the square of its group. Beyond ``most`` entries the
entries of a key are linked by centres instead: each sends itself and its neighbours at one bit, of the bits that the
key leaves free. Entries within two bits of each other have a centre in common, entries with a centre in common are
within two bits, and a centre has 65 entries at most. So nothing is lost, and rows stay in proportion to the entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import long_column, slices, store
from hirelens.llm.components import connected

BITS = 64
BITS_APART = 2  # centres one bit away link entries two bits apart
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes, words: int, part: int = 1 << 20) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the word shingles of a text, in arrays of about ``part`` bytes of text.

    A-Z are lower-cased; words are runs without ASCII blanks, joined by a space. Fewer words than ``words`` make one
    shingle, no words none.
    """
    carry, low, whole = [], 0, True
    while low < len(text):
        high = low + part
        if high < len(text):  # a part ends at a blank
            end = BLANK.search(text, high)
            high = end.start() if end else len(text)
        found = carry + text[low:high].lower().split()
        low = high
        carry = found[len(found) - words + 1:] if len(found) >= words else found
        if len(found) < words:
            continue
        whole = False
        joined = b" ".join(found)
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size + 1) - 1
        starts = (ends - size)[:len(found) - words + 1].tolist()
        hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1:].tolist())]
        yield np.array(hashes, np.uint64)
    if whole and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), 42)], np.uint64)


def fingerprint(text: bytes, words: int) -> int:
    count, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, words):
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at:at + (1 << 16)]
            count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.int64)[0]) if n else 0


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fingerprint (a bigint whose bits count) of every row; a null, empty or blank text has zero."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [fingerprint(text, words) if text else 0
                    for text in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), long_column(made)], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, fingerprint bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, most: int = 64) -> DataFrame:
    """Edges a, b that connect the distinct fingerprints (column ``fingerprint``) that differ in two bits at most."""
    blocks = BITS_APART + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for pair in combinations(range(blocks), 2):
        kept = [bit for block in pair for bit in range(cuts[block], cuts[block + 1])]
        masks.append((_signed(sum(1 << b for b in kept)), [_signed(1 << b) for b in range(BITS) if b not in kept]))
    entry = F.col("fingerprint")
    keys = F.array(*[F.struct(F.lit(i).alias("table"), entry.bitwiseAND(F.lit(mask)).alias("key"))
                     for i, (mask, _) in enumerate(masks)])
    keyed = prints.select("fingerprint", F.inline(keys))
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("entries")).where("entries > 1")
    shared = store(keyed.join(shared, ["table", "key"]), "blocks")

    few = shared.where(F.col("entries") <= most)
    pairs = few.select("table", "key", F.col("fingerprint").alias("a")).join(
        few.select("table", "key", F.col("fingerprint").alias("b")), ["table", "key"])
    pairs = pairs.where("a < b").where(distance(F.col("a"), F.col("b")) <= BITS_APART).select("a", "b")

    many = shared.where(F.col("entries") > most)
    free = F.array(*[F.array(*map(F.lit, bits_)) for _, bits_ in masks])
    near = F.concat(F.array(entry), F.transform(free[F.col("table")], lambda bit: entry.bitwiseXOR(bit)))
    centres = many.select("fingerprint", F.explode(near).alias("centre"))
    around = centres.groupBy("centre").agg(F.collect_set("fingerprint").alias("around")).where(F.size("around") > 1)
    stars = around.select(F.array_min("around").alias("a"), F.explode("around").alias("b")).where("a <> b")
    stars = stars.where(distance(F.col("a"), F.col("b")) <= BITS_APART)
    return store(pairs.union(stars).distinct(), "links")


def near_duplicates(docs: DataFrame, words: int = 3, most: int = 64) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs``.

    component_id is the smallest doc_id reachable over fingerprints that differ in two bits at most. Null, empty
    and blank texts have fingerprint zero and are linked like any other; repeated rows stay as they are. A null doc_id
    is the component's only if it has no other. Texts of any length are read in parts. Only doc_id and text are read,
    so other columns, whatever their names, take no part; an empty table gives no rows. Runs jobs when called.
    """
    facts = store(fingerprints(docs, words), "prints")
    classes = store(facts.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    labels = connected(links(classes.select("fingerprint"), most))
    named = classes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("label", F.coalesce("label", "fingerprint"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("fingerprint", "component_id")
    return facts.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
