"""Encoding of very long texts and runs, against the tokenizer library."""

import random

import numpy as np
import pytest

from hirelens.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder("byte_bpe_50k")


def whole(encoder, text):
    return encoder.model.encode(text, add_special_tokens=False).ids


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_parts_equal_whole_texts(encoder):
    """Parts of some dozens of characters, with blanks, contractions, marks and scripts at the cuts."""
    small = packing.Encoder("byte_bpe_50k", part=24)
    pick = random.Random(6)
    tokens = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "don't", "we'll", "_", "...", "42", "é", "日本語", " ", " ",
              "x" * 90, " " * 90, "\n" * 90, "Đ" * 70, "<|endoftext|>", "\U0001F600", "'s", "\r\n", "\x1c", "᠎", "ǅ", "½"]
    for _ in range(400):
        text = "".join(pick.choices(tokens, k=pick.randrange(1, 40)))
        assert ids(small.encode(text)) == whole(encoder, text)


@pytest.mark.parametrize("run", [" ", "\n", "q", "xq", "é", "日", " \n"])
def test_long_runs_equal_the_library(encoder, run):
    text = "start " + run * 300_000 + "z end of it"
    assert ids(encoder.encode(text)) == whole(encoder, text)


def test_ten_million_blanks_and_letters(spark):
    n = 10_000_000
    table = spark.createDataFrame([(i,) for i in range(3)], "doc_id long").repartition(3).selectExpr(
        "doc_id", f"concat(repeat(element_at(array(' ', '\n', 'q'), int(doc_id + 1)), {n}), 'z') as text")
    rows = packing.pack(packing.token_pieces(table)).groupBy("doc_id").sum("length").collect()
    one = packing.Encoder("byte_bpe_50k")
    counts = [len(whole(one, c * 100_000)) for c in " \nq"]
    got = {r.doc_id: r["sum(length)"] for r in rows}
    for i, count in enumerate(counts):  # runs are merged in steps of a few characters, so lengths grow in proportion
        assert abs(got[i] - n // 100_000 * count) < 16
