"""What Python workers hold beside an executor's heap, on small tables."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hirelens.llm import jaccard, langid, sharding


def test_records_are_shuffled_in_buckets_without_passing_through_python(spark, monkeypatch):
    rows = [(i, "t" * (i % 90)) for i in range(400)] + [(7, "again")] * 30 + [(None, None), (None, "x"), (5, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = []
    plain = sharding._second_pass
    monkeypatch.setattr(sharding, "_second_pass", lambda scattered, *a: seen.append(scattered) or plain(scattered, *a))
    size = F.coalesce(F.length("text"), F.lit(0)) + 1
    out = sharding.shuffle_shards(table, 4, size, seed=5, bucket_bytes=3000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan
    through = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(through) == 1 and "text" not in through[0].split("]")[0] and "doc_id" not in through[0].split("]")[0]
    # the whole order by the book: buckets one after the other, each sorted by hash and shuffled
    buckets = {}
    for r in seen[0].collect():
        buckets.setdefault(r["__bucket"], []).append((r["__rec"], r.doc_id, r.text))
    assert len(buckets) > 3
    order = []
    for number in sorted(buckets):
        held = sorted(buckets[number], key=lambda r: r[0])
        order += [held[i][1:] for i in sharding.fisher_yates(len(held), [5, number])]
    got = sorted(out.collect(), key=lambda r: (r.shard, r.slot))
    assert [(r.doc_id, r.text) for r in got] == order
    assert [r.shard for r in got] == [at * 4 // len(rows) for at in range(len(rows))]


def test_places_of_a_bucket_that_is_cut_into_batches(spark):
    """A bucket's places are the same whether one Arrow batch holds it or many."""
    rows = spark.range(0, 1000, 1, 2).select(
        (F.col("id") < 300).cast("long").alias("b"), F.when(F.col("id") < 300, 300).otherwise(700).alias("n"),
        F.when(F.col("id") < 300, F.col("id")).otherwise(F.col("id") - 300).alias("at")).coalesce(1)
    placed = rows.withColumn("place", sharding.shuffled_place(F.col("b"), F.col("n"), F.col("at"), 3))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "128")
        got = placed.collect()
    finally:
        spark.conf.set(key, before)
    for number, size in ((0, 700), (1, 300)):
        own = {r["place"]: r["at"] for r in got if r["b"] == number}
        assert [own[i] for i in range(size)] == np.array(sharding.fisher_yates(size, [3, number])).tolist()


def features_by_the_book(text):
    """Counts of the hashed trigrams of one text, byte for byte in whole numbers without bounds."""
    code = []
    for i, byte in enumerate(data := text.encode()):
        letter = byte >= 128 or chr(byte).isalpha()
        code.append((byte | 0x20 if byte < 128 else byte) if letter else 32)
        if i and data[i - 1] == 0xC3 and 0x80 <= byte <= 0x9E:
            code[-1] += 0x20
    out = np.zeros(langid.FEATURES, np.int64)
    for a, b, c in zip(code, code[1:], code[2:]):
        if (a != 32) + (b != 32) + (c != 32) >= 2:
            number = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2 ** 32
            out[((number ^ (number >> 15)) * 0x2C1B3C6D % 2 ** 32) >> 19] += 1
    return out


def test_counting_trigrams_needs_memory_for_a_slice_only():
    """Texts of 6 MB in one batch: the worker holds a small part of them as numbers at a time."""
    short = [None, "", "a", "ab", "\u00c9t\u00e9 Na\u00efve 9 x", "\u65e5\u672c\u8a9e", "The end. " * 3]
    texts = pa.array(short + [f"text number {i} " + "of many words " * 140 for i in range(3000)], pa.string())
    assert texts.nbytes > 5_000_000
    grams = langid.Grams()
    tracemalloc.start()
    seen = sum(1 for _ in grams.counts(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(texts)
    assert peak < 16_000_000
    counts = list(grams.counts(texts.slice(0, 40)))
    for text, found in zip(texts.slice(0, 40).to_pylist(), counts):
        assert (found == features_by_the_book(text or "")).all()


def test_shingling_needs_memory_for_a_part_only():
    """Two megabytes of texts at once; hashes are the same however the bytes are parted, also in a word at an edge."""
    texts = pa.array([None, "", "one", "y" * 300_000 + " and more words here", *(
        f"text {i} " + " ".join(f"w{i * j % 977}" for j in range(400)) for i in range(900))], pa.string())
    assert 1_800_000 < texts.nbytes < 2_500_000
    shingler = jaccard.Shingler(5)
    tracemalloc.start()
    row, hashes = shingler.hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64_000_000
    for part in (1000, 4 << 20):
        again = jaccard.Shingler(5).hashes(texts, part=part)
        assert (again[0] == row).all() and (again[1] == hashes).all()
