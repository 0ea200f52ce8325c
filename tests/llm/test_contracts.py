"""The queries of the first ten operators on the smallest tables: columns, types and whole results in plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF

import oracle
from hirelens.llm import packing, queries

LONG, TEXT = "bigint", "string"
COLUMNS = {
    "op1_sharding": dict(doc_id=LONG, size=LONG, text_crc32=LONG, law=TEXT, shard="int", slot=LONG, grown_shard="int"),
    "op2_secrets": dict(doc_id=LONG, n_assign=LONG, n_access=LONG, n_hex=LONG, base_sha256=TEXT, spans=TEXT),
    "op5_forest": dict(query_id=LONG, rank="int", vec_id=LONG, score="double"),
    "op7_langid": dict(doc_id=LONG, held_out="boolean", lang_pred=TEXT, score="double"),
    "op8_packing": dict(doc_id=LONG, start=LONG, length=LONG, ids_crc32=LONG, doc_tokens=LONG, sequence_id=LONG, offset=LONG),
    "op9_merkle": dict(doc_id=LONG, n_chars=LONG, edited_sha256=TEXT, fingerprint=TEXT, edited_fingerprint=TEXT,
                       near_edited="double", near_next="double"),
    "op10_jaccard": dict(doc_id=LONG, n_shingles=LONG, component_id=LONG),
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    df = queries.QUERIES[name](spark, SF)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    return df.collect()


def test_op1(spark, texts):
    rows = result(spark, "op1_sharding")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    shards = [sorted(r.slot for r in rows if r.shard == s) for s in range(16)]
    assert all(s == list(range(len(s))) for s in shards) and max(map(len, shards)) - min(map(len, shards)) <= 1


BASE = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]


def base_spans(text):
    out = []
    for nth, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            if kind == "assign" and len(m[2]) >= 12 or kind == "access" and len(m[0]) >= 18 or kind == "hex" and len(m[0]) >= 16:
                out.append((m.start(), nth, kind, m.end()))
    return sorted(out)


def test_op2(spark, texts):
    for r in result(spark, "op2_secrets"):
        found = base_spans(texts[r.doc_id].text or "")
        told = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[2] == k for x in found) for k, _ in BASE)
        assert set(told.split(",")) <= set(r.spans.split(",")) or not told


def test_op3_and_op4(spark, texts):
    coded = queries.op3_pieces(spark, SF).collect()
    assert len(coded) == len(texts) and all(r.round_trip for r in coded if "▁" not in (texts[r.doc_id].text or ""))
    changed = queries.op4_surrogates(spark, SF).collect()
    assert len(changed) == len(texts)
    same = lambda r: hashlib.sha256((texts[r.doc_id].text or "").encode()).hexdigest() == r.new_sha256
    assert all(same(r) == (r.n_changes == 0) for r in changed) and any(r.n_changes for r in changed)


def test_op5(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    cosine = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)
    got = {}
    for r in result(spark, "op5_forest"):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == sorted(i for i in ids if i % 50 == 0)
    hits = 0
    for q, found in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        assert [rank for rank, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        scores = [cosine[at, np.flatnonzero(ids == v)[0]] for _, v, _ in sorted(found)]
        assert np.allclose(scores, [s for _, _, s in sorted(found)], atol=1e-12) and scores == sorted(scores, reverse=True)
        best = [ids[i] for i in np.lexsort((ids, -cosine[at])) if i != at][:5]
        hits += len(set(best) & {v for _, v, _ in found})
    assert hits >= 0.9 * 5 * len(got)


def test_op6(spark):
    assert oracle.differences(queries.op6_licences(spark, SF), oracle.connect(SF), queries.ORACLES["op6_licences"]) == []


def test_op7(spark, texts):
    rows = result(spark, "op7_langid")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    right = []
    for r in rows:
        doc = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", doc.text or ""))
        if r.held_out and doc.lang and len(doc.text or "") > 100:
            right.append(r.lang_pred == doc.lang)
    assert sum(right) >= 0.9 * len(right) > 0


def test_op8(spark, texts):
    model = packing.Encoder("byte_bpe_50k").model
    pieces, sequences = {}, {}
    for r in result(spark, "op8_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for i, some in pieces.items():
        ids = np.array(model.encode(texts[i].text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(some, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(sequences) * 2048 <= 1.08 * sum(r.length for some in pieces.values() for r in some) + 2048


def test_op9(spark, texts):
    order = sorted(texts)
    rows = {r.doc_id: r for r in result(spark, "op9_merkle")}
    assert sorted(rows) == order
    prints = {}
    for i, after in zip(order, [*order[1:], order[0]]):
        text, other = texts[i].text or "", texts[after].text or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + other[:cut]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        prints.setdefault(text, set()).add(rows[i].fingerprint)
        prints.setdefault(edited, set()).add(rows[i].edited_fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    long = [r for r in rows.values() if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.3


def test_op10(spark, texts):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if len(words) < 4:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(tuple(words[i:i + 4]) for i in range(len(words) - 3))

    ids = sorted(texts)
    sets = {i: shingles(texts[i].text) for i in ids}
    label = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in result(spark, "op10_jaccard"))
    assert got == [(i, len(sets[i]), label[i]) for i in ids]
