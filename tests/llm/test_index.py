"""The block index of the Jaccard join: linked sets meet in it, unrelated sets do not; what its results make others send."""

import glob
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelens.llm import jaccard


def index(spark, texts, words, percent):
    """Blocks of the index as (block, doc_id)."""
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    keys = jaccard.set_rows(table, words, 0).select("doc_id", "key")
    rows = jaccard.block_rows(table, words, 0, jaccard.Law(percent)).distinct()
    return rows.join(keys, "key").select("block", "doc_id").cache()


@pytest.mark.parametrize("percent", [50, 80, 85, 97])
def test_linked_sets_share_a_block(spark, percent):
    """Pairs as far apart as the threshold lets them be, of equal and of different sizes, meet in a block."""
    rng = np.random.default_rng(percent)
    texts, linked = [], 0
    for n in [*range(1, 90), *rng.integers(90, 1200, 80).tolist()]:
        for share in (0.0, 0.5, 1.0):  # of the difference, what b has more than a
            a = [f"w{i}" for i in rng.integers(10**12, size=n)]
            more = fewer = 0
            for _ in range(n):
                step = (more + 1, fewer) if more + 1 <= share * (more + fewer + 1) else (more, fewer + 1)
                if 100 * (n - step[1]) < percent * (n + step[0]):
                    break
                more, fewer = step
            texts += [" ".join(a), " ".join(a[fewer:] + [f"m{i}" for i in rng.integers(10**12, size=more)])]
            linked += more + fewer > 0
    rows = index(spark, texts, 1, percent)
    met = rows.withColumn("pair", F.floor(F.col("doc_id") / 2)).groupBy("block", "pair").agg(
        F.countDistinct("doc_id").alias("n")).where("n = 2").select("pair").distinct()
    found = {r.pair for r in met.collect()}
    apart = [i for i in range(len(texts) // 2) if set(texts[2 * i].split()) != set(texts[2 * i + 1].split())]
    assert len(apart) == linked > 200
    assert [i for i in apart if i not in found] == []


def test_unrelated_sets_share_no_block(spark):
    """Empty blocks, which unrelated sets have in common, are not sent; nor are more filled blocks than are needed."""
    rng = np.random.default_rng(2)
    sizes = rng.integers(30, 700, 1500).tolist()
    rows = index(spark, [" ".join(f"w{i}" for i in rng.integers(10**12, size=n)) for n in sizes], 1, 80)
    shared = rows.groupBy("block").count().where("count > 1").count()
    assert shared <= 20
    assert rows.count() <= 0.4 * sum(sizes)


def test_texts_that_stay_are_not_sent(spark):
    """Without broadcast joins, only texts that may be dropped go through the exchange of the result."""
    key, copies = "spark.sql.autoBroadcastJoinThreshold", 20
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{i:x}" for i in rng.integers(2**60, size=300)) for _ in range(1500)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(10_000 + i, t, "en", "s", len(t)) for i, t in enumerate(texts[:copies])] + rows[-5:] * 2
    rows += [(None, texts[7], None, None, None), (None, " ", None, None, 1), (20_000, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = corpus_pipeline.store(docs, "docs")
    root = spark.conf.get("spark.local.dir", None) or os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    files = lambda: set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True))
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, docs, "")
        old = files()
        kept = [r.doc_id for r in out.select("doc_id", "text").collect()]
        sent = sum(os.path.getsize(f) for f in files() - old)
    finally:
        spark.conf.set(key, before)
    assert sorted(i for i in kept if i is not None) == [*range(1500), 20_000] and kept.count(None) == 1
    assert sent < 0.2 * sum(map(len, texts))
