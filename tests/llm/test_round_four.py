"""Pieces without a way back, on words and columns that are awkward; what the Jaccard join sends and leaves on disk."""

import glob
import math
import os
import random
import tempfile
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import common, jaccard, pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.piece_rows("piece_bpe_32k.model"), pieces.byte_ids("piece_bpe_32k.model")


def plain_path(word, scores, bytes_):
    """Ids of the best path by the book; of equal paths to a place the one with the longer last piece stays."""
    best = [(0.0, [])] + [(-math.inf, [])] * len(word)
    for high in range(1, len(word) + 1):
        for low in range(max(0, high - 16), high):
            piece = word[low:high]
            if piece in scores:
                id_, score = scores[piece]
            elif high == low + 1:
                id_, score = None, len(piece.encode()) * pieces.BYTE_SCORE
            else:
                continue
            if best[low][0] + score > best[high][0]:
                ids = [id_] if id_ is not None else [bytes_[b] for b in piece.encode()]
                best[high] = best[low][0] + score, best[low][1] + ids
    return best[-1][1]


def test_words_have_the_same_path_in_tasks_and_in_the_relational_lattice(spark, vocabulary):
    rows, bytes_ = vocabulary
    assert max(len(p) for _, p, _ in rows) <= 16
    draw = random.Random(4)
    words = {"▁" * 3 + "abc", "▁" * 200, "\n", "▁漢字かなカナ", "▁😀é\x00z", "a" * 200, "▁" * 700 + "x", "\U0010ffff"}
    words |= {"▁" + "".join(draw.choices("etaoinshr.,-1é漢😀", k=draw.randint(1, 30))) for _ in range(500)}
    words = sorted(words)
    scores = {p: (i, s) for i, p, s in rows}
    plain = [plain_path(w, scores, bytes_) for w in words]
    lattice = pieces.Lattice(rows, bytes_)
    for part in (100_000, 50, 1):  # many words at once, few, and a place at a time
        assert [np.frombuffer(x, "<i4").tolist() for x in lattice.paths(words, part)] == plain
    table = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r.word: r.ids for r in pieces.encoded_words(table, rows, bytes_).collect()} == dict(zip(words, plain))
    assert list(lattice.paths([])) == []


def test_paths_go_back_without_an_exchange(spark, capsys):
    texts = [None, "", " ", "one two  three\nfour", "日本語のテキスト 😀", "x" * 900] + [
        " ".join(f"w{i * j % 37}" for j in range(40)) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "own", 7) for i, t in enumerate(texts)],
                                 "doc_id long, text string, own string, word int")
    coded = pieces.encode(docs)
    coded.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert coded.columns == ["doc_id", "text", "own", "word", "ids"]
    rows = {r.doc_id: r for r in coded.withColumn("back", pieces.decoded(F.col("ids"))).collect()}
    assert len(rows) == len(texts) and all(r.own == "own" and r.back == (texts[i] or "") for i, r in rows.items())
    ids = {i: r.ids for i, r in rows.items()}
    for frequent, remember in ((0, 10**6), (1, 10**6), (1, 0)):  # all repeated words in the table, none, none remembered
        other = pieces.encode(docs, frequent=frequent, remember=remember)
        assert {r.doc_id: r.ids for r in other.collect()} == ids


def test_texts_that_are_not_needed_are_not_sent(spark):
    docs = spark.range(20_000).select(
        F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 10_000).alias("text"))
    docs = docs.union(docs.where("doc_id is null or doc_id = 7"))  # copies of a row, and texts under two ids
    wanted = F.coalesce("doc_id", F.lit(0)).isin(0, 7, 4_000, 10_007, 19_999)
    classes = docs.where(wanted).distinct().select(
        F.coalesce("doc_id", F.lit(0)).alias("key"), "doc_id", F.xxhash64("text").alias("hash"))
    rows = jaccard.texts_of(classes.select("key"), classes, docs).collect()
    assert sorted((r.key, r.text) for r in rows) == [
        (i, f"text {i % 10_000}") for i in (0, 7, 4_000, 10_007, 19_999)]
    mark = F.xxhash64("doc_id", "text").alias("__mark")
    sent = jaccard.marked(docs.select("doc_id", mark), docs.where(wanted).select(mark))
    assert sent.columns == ["doc_id", "__mark"]
    ids = [r.doc_id or 0 for r in sent.collect()]
    assert {0, 7, 4_000, 10_007, 19_999} <= set(ids) and len(ids) < 50
    nothing = jaccard.marked(docs.select("doc_id", mark), docs.where("false").select(mark))
    assert nothing.count() == 0


def test_a_stored_step_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    root = spark.conf.get("spark.local.dir", None) or os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    files = lambda: set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True))
    before, set_before = files(), spark.conf.get(key, None)
    rows = spark.range(10_000).repartition(5, "id")
    stored = common.store(rows, "step")
    for _ in range(50):  # files are removed a little later
        left = files() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and stored.count() == rows.count() == 10_000
    assert spark.conf.get(key, None) == set_before
