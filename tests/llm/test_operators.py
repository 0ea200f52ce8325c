"""Every corpus operator on small tables with nulls, empty and repeated texts, ties and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.llm import (
    forest, jaccard, langid, licences, merkle, packing, pieces, secret_links, sharding, surrogates,
)

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
TEXTS = [
    None, "", "one", "One", LONG, LONG, LONG.replace("w7 ", "x7 "), " ".join(WORDS[200:]), "a b c d e", "A b\tc  d e",
    'token = "abcdefghijklmnop" end', "card 4111111111111111, again 4111111111111111",
    "mail Bob.Ray@mail.example.org or bob.ray@mail.example.org, +1 (555) 123-4567, 10.1.2.3",
    "Mrs Ada Byron met Mr Byron", "Released under the MIT License.\nCopyright (c) 2020 X\nfin", "é\U0001F600 b. C!\n\nD",
    "日本語のテキスト", "x" * 3000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if t else None, "key", 1) for i, t in enumerate(TEXTS)]
    rows += [(4, LONG, "en", "key", 1), (None, "one", "en", "key", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, shard int").coalesce(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_sharding(docs, none):
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    rows = sharding.shuffle_shards(docs, 3, size, bucket_bytes=500).collect()
    order = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows)
    assert order(rows) == order(docs.collect())
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.shuffle_shards(docs.repartition(5), 3, size, bucket_bytes=500).collect()
    assert {(r.doc_id, r.text, r.shard) for r in again} == {(r.doc_id, r.text, r.shard) for r in rows}
    assert sharding.shuffle_shards(none, 3, size).count() == 0
    assert sorted(sharding.fisher_yates(50, [1, 2])) == list(range(50))


def test_packing(docs, none):
    rows = packing.pack(packing.token_pieces(docs, length=64, keep_ids=True), length=64, unit=4).collect()
    whole, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id not in (4, None):
            whole.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    encoder = packing.Encoder("byte_bpe_50k")
    for doc_id, parts in whole.items():
        ids = encoder.model.encode(TEXTS[doc_id] or "", add_special_tokens=False).ids + [1]
        assert b"".join(p for _, p in sorted(parts)) == np.array(ids, "<u4").tobytes()
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.token_pieces(none)).count() == 0


def test_cutting_stock_covers_demand_near_the_bound():
    demand = np.zeros(32, np.int64)
    demand[[3, 6, 10, 12, 16, 20]] = [400, 350, 120, 300, 90, 80]
    plan = packing.cutting_stock(demand, 32)
    assert (sum(p * n for p, n in plan) >= demand).all()
    assert all((p * np.arange(1, 33)).sum() <= 32 for p, _ in plan)
    bound = (demand * np.arange(1, 33)).sum() / 32
    assert sum(n for _, n in plan) <= 1.08 * bound + 8


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


@pytest.mark.parametrize("words,percent", [(4, 85), (2, 50)])
def test_jaccard_equals_brute_force(spark, none, words, percent):
    rng = np.random.default_rng(3)
    texts = list(TEXTS)
    for _ in range(60):  # families with shared passages and edits
        base = rng.choice(WORDS, rng.integers(3, 120)).tolist()
        for _ in range(rng.integers(1, 5)):
            at = rng.integers(0, len(base), rng.integers(0, 4))
            texts.append(" ".join(w if i not in at else "edit" for i, w in enumerate(base + WORDS[:rng.integers(0, 9)])))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in jaccard.similar_components(table, words, percent).collect()}
    sets, parent = [shingles(t, words) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == [find(i) for i in range(len(texts))]
    assert jaccard.similar_components(none).count() == 0


def plain_components(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if find(i) != find(j) and 100 * min(len(a), len(sets[j])) >= percent * max(len(a), len(sets[j])):
                if 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("many, part_bytes", [(50_000, 20_000), (20, 32 << 20)])
def test_jaccard_of_a_large_near_group(spark, many, part_bytes, monkeypatch):
    """Near copies of one text, about half of them linked, in more than one part of a family; no pairs are made of it."""
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(150)]
    texts = [" ".join(base)]
    for _ in range(700):
        at = set(rng.integers(0, 150, rng.integers(1, 16)).tolist())
        texts.append(" ".join(f"e{rng.integers(10**9)}" if i in at else w for i, w in enumerate(base)))
    joined = []
    plain = jaccard.joining_links

    def counted(rows, *args):
        out = plain(rows, *args, part_bytes)
        joined.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard, "joining_links", counted)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in jaccard.similar_components(table, 5, 80, many=many, label="own").collect()}
    expected = plain_components([shingles(t, 5) for t in texts], 80)
    assert [got[i].component_id for i in range(len(texts))] == expected
    assert len({r.own for r in got.values()}) == len(set(expected)) > 100
    assert all(made <= 3 * rows for rows, made in joined)


def test_sketches_bound_the_difference(spark):
    """Sketches of sets of any two sizes differ in no more bits than the sets in elements."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.permutation(WORDS * 3)[:n].tolist()) for n in (3, 40, 250, 270, 500, 530, 1100)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = sorted(jaccard.set_rows(table, 2, 0).collect(), key=lambda r: r.doc_id)
    sets = [shingles(t, 2) for t in texts]
    assert len({len(r.sketch) for r in rows}) > 2
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows))]
    column = lambda k: pa.array([bytes(rows[p[k]].sketch) for p in pairs], pa.binary())
    for (i, j), ones in zip(pairs, jaccard._ones(column(0), column(1))):
        assert ones <= len(sets[i] ^ sets[j]) and (i != j or ones == 0)


def test_repeated_ids_and_null_ids(docs):
    rows = jaccard.similar_components(docs).collect()
    assert len(rows) == docs.count()
    assert {r.component_id for r in rows if r.doc_id in (4, 5, 6)} == {4}


def test_secrets(spark, docs, none):
    found = {r.doc_id: r for r in secret_links.secret_spans(docs).select(
        "doc_id", secret_links.told(F.col("spans")).alias("s"),
        secret_links.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert found[10].s == "assign:0:25" and found[10].t == "[secret] end".replace("] ", ']" ')
    assert found[0].s == "" and found[0].t is None and found[11].s == "hex:5:21,hex:29:45"
    parts = spark.createDataFrame([
        (1, "login: ada99\npwd: hunter22\nhost: db.example.org"), (2, "login: ada99\n\npwd: hunter22"), (3, "pwd: hunter22"),
    ], "doc_id long, text string")
    told = {r[0]: r[1] for r in secret_links.secret_spans(parts).select(
        "doc_id", secret_links.told(F.col("spans"))).collect()}
    assert told == {1: "part_id:0:12,part_secret:13:26,part_endpoint:27:47", 2: "", 3: ""}
    assert secret_links.secret_spans(none).count() == 0


def test_surrogates(docs, none):
    rows = {r.doc_id: r for r in surrogates.replace_personal_data(docs, "k").collect()}
    mail = [c for c in rows[12].changes if c.kind == "email"]
    assert len(mail) == 2 and mail[0]["with"].lower() == mail[1]["with"].lower() != "bob.ray@mail.example.org"
    phone = next(c["with"] for c in rows[12].changes if c.kind == "phone")
    assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", phone)
    card = [c["with"] for c in rows[11].changes]
    assert card[0] == card[1] != "4111111111111111" and len(card[0]) == 16
    digits = [int(c) for c in card[0]][::-1]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    name = re.fullmatch(r"Mrs ([A-Z][a-z]*a) ([A-Z][a-z]+) met Mr ([A-Z][a-z]+)", rows[13].new_text)
    assert name and name[2] == name[3] != "Byron"
    assert rows[0].new_text is None and rows[4].new_text == LONG
    assert surrogates.replace_personal_data(none, "k").count() == 0


def test_forest_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8))
    x[250:] = x[0]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    rows += [(900, None, "a"), (901, [0.0] * 8, "a"), (902, [float("nan")] * 8, "a"), (903, [1.0], "a"), (None, [1.0] * 8, "a")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")
    got = {}
    for r in forest.nearest(table, lambda v: v % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        best = np.lexsort((np.arange(300), -score))[:5]
        assert [v for _, v, _ in sorted(got[q])] == best.tolist()
    assert forest.nearest(table.where("false"), lambda v: v % 50 == 0).count() == 0


def test_language(spark, docs, none):
    rng = np.random.default_rng(1)
    syllables = {"aa": ["ba", "ke", "lo"], "bb": ["strum", "pf", "zig"]}
    rows = [(f" ".join("".join(rng.choice(s, 3)) for _ in range(30)), lang, i) for lang, s in syllables.items() for i in range(30)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string, order long"))
    texts = spark.createDataFrame([("balokeba kelo baba",), ("strumpfzig zigpf",), (None,), ("12 !",), ("q" * 90,)], "text string")
    out = {r.text: r for r in langid.predict(texts, model).collect()}
    assert out["balokeba kelo baba"].lang_pred == "aa" and out["strumpfzig zigpf"].lang_pred == "bb"
    assert out[None].lang_pred == out["12 !"].lang_pred == "und" and out[None].rejected
    assert out["q" * 90].rejected and out["q" * 90].lang_pred in ("aa", "bb")
    assert all(0 <= r.score <= 1 for r in out.values())
    empty = langid.fit(none.select("text", "lang", F.lit(1).alias("order")))
    assert langid.predict(docs, empty).where("rejected").count() == 2


def test_merkle(docs, none):
    rows = merkle.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), merkle.fingerprint(
        F.col("text")).alias("print")), rows_per_range=4)
    rows = rows.select("*", merkle.edited(F.col("text"), F.col("next_text")).alias("edited")).collect()
    assert len(rows) == docs.count()
    ids = sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    by = {(r.doc_id is not None, r.doc_id or 0, r.text): r for r in rows}
    for k, key in enumerate(ids):
        if key[1] != 4:
            assert by[key].next_text == ids[(k + 1) % len(ids)][2]
        n = len(key[2]) // 4
        assert by[key].edited == key[2][:len(key[2]) - n] + by[key].next_text[:n]
    prints = {r.text: r.print for r in rows}
    assert len(set(prints.values())) == len(prints)
    assert merkle.with_next(none.withColumn("print", F.lit(""))).count() == 0


def test_merkle_differences(spark):
    table = spark.createDataFrame([("One. Two.\n\nThree. Four.", "One. Two.\n\nThree. Five.")], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    row = table.select(merkle.differing(a, b).alias("d"), merkle.likeness(a, b).alias("l"), merkle.likeness(a, a).alias("s")).first()
    assert [(x.section, x.paragraph, x.leaf) for x in row.d] == [(1, 0, 1)] and row.l == 0.75 and row.s == 1


def test_licences(docs, none):
    rows = {r.doc_id: r for r in licences.find_licences(docs).collect()}
    assert rows[14].notices == ["MIT"] and rows[14].licence is None
    assert rows[0].digest == rows[1].digest == hashlib.sha256(b"").hexdigest()
    assert licences.find_licences(none).count() == 0


def test_pieces(docs, none):
    import sentencepiece
    import public_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.encode(docs).select("doc_id", "text", "ids", pieces.decoded(F.col("ids")).alias("back"))
    for r in coded.collect():
        assert r.back == (r.text or "") == model.decode(list(r.ids))
    assert pieces.encode(none).count() == 0
