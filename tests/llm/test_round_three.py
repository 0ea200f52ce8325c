"""Conversation repair, hard negatives and SimHash against plain versions, and on awkward tables."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from conftest import SF, SF_GATE
from pyspark.sql import functions as F

import oracle
from hirelens.llm import negatives, queries, simhash, turns

# ---- conversation repair ----


def plain_repair(rows):
    """Contract of op11 for one conversation, without checkpoints: rows are (turn, role, text) in order."""
    seen, facts = set(), []
    counts = dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                 else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        facts.append(fault)

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def add(cost, letter, line, i, state, inserted=0):
            rest = best(i, state, inserted)
            if rest:
                options.append((cost + rest[0], letter + rest[1], line + rest[2]))

        follow = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
        if inserted < 3:
            for role in ("user", "assistant"):
                if (role[0], state) in follow:
                    add(2, "I", (f"{role}:",), i, follow[role[0], state], inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            add(3, "D", (), i + 1, state)
            if facts[i] not in ("blank", "duplicate"):
                extra = facts[i] == "truncated"
                if (role[:1], state) in follow:
                    add(extra, "K", (f"{role}:{text}",), i + 1, follow[role[:1], state])
                for new in ("user", "assistant"):
                    if (new[0], state) in follow:
                        add(2 + extra, "R", (f"{new}:{text}",), i + 1, follow[new[0], state])
        return min(options) if options else None

    for i in range(len(rows), 0, -1):  # from the back, so that no call goes deep
        for state in range(4):
            best(i, state, 0)
    cost, audit, lines = best(0, 0, 0)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return dict(gaps=gaps, illegal=illegal, cost=cost, audit=audit,
                repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest(), **counts)


def by_conversation(rows):
    said = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out.setdefault(conv, []).append((turn, role, text))
    for turns_ in out.values():
        turns_.sort(key=lambda r: (r[0] is not None, r[0] or 0, said(r[1], r[2])))
    return out


def told(rows):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in rows}


@pytest.fixture(scope="module")
def conversations(spark):
    """Random turns with nulls, ties, repeats, odd roles, one conversation that holds a third of all rows."""
    pick = random.Random(5)
    texts = ["Yes.", "No!", "and then", "", " \t", None, "é?\n", "fine. ", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "ursula"]
    rows = []
    for conv in [None, *range(25)]:
        for _ in range(pick.choice([1, 2, 5, 9, 14])):
            text = pick.choice(texts) if pick.random() < 0.4 else f"t{pick.randrange(10**6)}" + pick.choice([".", "!", ""])
            rows.append((conv, pick.choice([None, *range(12)]), pick.choice(roles), text))
    rows += [(77, i // 2, pick.choice(roles[:3]), f"h{pick.randrange(90)}" + pick.choice(".!? ")) for i in range(150)]
    rows += pick.sample(rows, 10)
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame(rows, schema).repartition(3)
    return rows, table.withColumn("unit", F.lit(1)).withColumn("at", F.lit("x")).withColumn("end", F.lit(0))


@pytest.mark.parametrize("per_cell", [1, 7, 4096])
def test_repair_equals_plain_dynamic_program(spark, conversations, per_cell, monkeypatch):
    rows, table = conversations
    monkeypatch.setattr(turns.math, "isqrt", lambda n: 0)  # so that cells are as small as asked
    units = turns.edited(table, per_cell)
    got = told(turns.with_all(table, turns.report(units)).collect())
    assert got == {conv: plain_repair(r) for conv, r in by_conversation(rows).items()}
    for conv, repaired in by_conversation([(r.conv_id, (r.at, r.nth), r.role, r.text)
                                           for r in turns.repaired_turns(units).collect()]).items():
        lines = "\n".join(f"{role}:{text}" for _, role, text in sorted(repaired))
        assert hashlib.sha256(lines.encode()).hexdigest() == got[conv]["repaired_sha256"]
        assert re.fullmatch("s?(ua)+", "".join(role[0] for _, role, _ in sorted(repaired)))


def test_walk_keeps_checkpoints_of_long_runs():
    pick = random.Random(3)
    rows = [(i, pick.choice(["user", "assistant", "system"]), f"{i}" + pick.choice([".", "", "!"])) for i in range(300)]
    units = [(False, not t.endswith((".", "!")), r[0], 1) for _, r, t in rows]
    steps = list(turns.walk(units, turns.END, 0))
    assert "".join(s[0] for s in steps) + "I" * len(turns.tail(steps[-1][5])) == plain_repair(rows)["audit"]


def test_repair_of_nothing(spark, conversations):
    _, table = conversations
    none = table.where("false")
    assert turns.with_all(none, turns.report(turns.edited(none))).count() == 0
    zeros = turns.with_all(table.where("conv_id = 3"), turns.report(turns.edited(none))).collect()
    assert told(zeros) == {3: plain_repair([])}


def test_op11_on_the_test_conversations(spark):
    df = queries.op11_repair(spark, SF_GATE)
    assert dict(df.dtypes) == {"conv_id": "bigint", "audit": "string", "repaired_sha256": "string", **dict.fromkeys(
        ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], "bigint")}
    source = spark.read.parquet(f"{SF_GATE}/conversations.parquet").collect()
    rows = []
    for r in source:
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if fault == 4 else r.role, text)] * {0: 0, 3: 2}.get(fault, 1)
    plain = {r.conv_id: plain_repair([]) for r in source}
    plain |= {conv: plain_repair(r) for conv, r in by_conversation(rows).items()}
    assert told(df.collect()) == plain


# ---- hard negatives ----


def plain_negatives(rows):
    """(vec_id, label, vector) rows: every anchor against all rows, in Python integers."""
    q = {(i, label, tuple(int(np.floor(256 * np.float64(x))) for x in v)) for i, label, v in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, a in q:
        if i % 100:
            continue
        scored = sorted((-max(min(dot(a, b), 2**63 - 1), 1 - 2**63), j, m) for j, m, b in q if j != i)
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            inside = [(-n, j) for n, j, m in scored if m != label and -30 * p <= -100 * n <= -90 * p][:10]
            out += [(i, pid, rank, j, -p, n) for rank, (n, j) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["scattered", "clustered", "few values", "huge"])
def test_negatives_equal_brute_force(spark, kind):
    draw = np.random.default_rng(7)
    n, d = 700, 8
    vectors = draw.normal(size=(n, d))
    if kind == "clustered":
        vectors = draw.normal(size=(6, d))[draw.integers(0, 6, n)] + 0.02 * vectors
    if kind == "few values":
        vectors = draw.integers(-1, 2, (n, d)) / 4
    if kind == "huge":
        vectors *= 10.0 ** draw.integers(-3, 6, (n, 1)) * np.where(draw.random((n, 1)) < 0.1, 1e25, 1)
    rows = [(i, int(draw.integers(0, 4)), v.tolist()) for i, v in enumerate(vectors)]
    rows += rows[:50]
    odd = [(100, None, [1.0] * d), (None, 1, [1.0] * d), (2, 1, None), (3, 1, [None] * d), (4, 1, [float("nan")] * d),
           (200, 1, [float("inf")] * d), (5, 2, [1e308] * d)]
    table = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>").repartition(3)
    table = table.withColumn("key", F.lit(1)).withColumn("tile", F.lit(2)).withColumn("q", F.lit("x"))
    found = negatives.hard_negatives(
        table, lambda i: i % 100 == 0, per_tile=90, per_part=3, window=8, references=5)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)


def test_angles_leave_windows_out():
    """On clustered vectors most windows are not scored, on the scattered ones of the test table few are left out."""
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 32))
    vectors = centres[draw.integers(0, 12, 3000)] + 0.05 * draw.normal(size=(3000, 32))
    q = np.floor(256 * vectors)
    norm, angle = negatives.angles(q, centres / np.linalg.norm(centres, axis=1, keepdims=True))
    table = negatives.pa.table({
        "vec_id": np.arange(3000), "key": np.arange(3000), "label": np.zeros(3000, np.int64), "norm": norm,
        "q": [negatives.packed(v) for v in q], "angles": [a.tobytes() for a in angle]})
    tile, anchors = negatives.Tile(table, 64), negatives.Anchors(table.slice(0, 40))
    lower, upper = tile.bounds(anchors.norm, anchors.angle)
    exact = negatives.scores(anchors.q, tile.q)
    for w, (a, b) in enumerate(tile.cuts):
        assert (lower[:, w] <= exact[:, a:b].min(axis=1)).all() and (exact[:, a:b].max(axis=1) <= upper[:, w]).all()
    fifth = np.sort(exact, axis=1)[:, -6]
    assert (upper >= fifth[:, None]).mean() < 0.3


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(none, lambda i: i % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (3, 2, []), (4, 3, [-1.0])], none.schema)
    assert [tuple(r) for r in negatives.hard_negatives(one, lambda i: i == 0).collect()] == [(0, 1, 1, 2, 65536, 32768)]


def test_op12_equals_sql(spark):
    df = queries.op12_negatives(spark, SF)
    assert oracle.differences(df, oracle.connect(SF), queries.ORACLES["op12_negatives"]) == []


# ---- SimHash ----


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """prints: (doc_id, fingerprint) rows; the least id reachable over two bits."""
    values = sorted({p for _, p in prints})
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                label[root(a)] = root(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(least.get(root(p), i), i)
    return {p: least.get(root(p)) for _, p in prints}


def test_fingerprints_of_whole_texts_equal_plain(spark):
    pick = random.Random(2)
    words = ["A", "b", "Cé", " ", "x" * 50, "İ", "ß", "\x1c"]
    texts = [None, "", " \n", "One", "one  TWO", "a b c", "A\tB\x0bc d"] + [
        pick.choice([" ", "\n", "\t "]).join(pick.choices(words, k=pick.choice([1, 2, 3, 40, 900]))) for _ in range(60)]
    texts += [" " * 3_000_000 + "end", "x" * 3_000_000, "ab " * 1_000_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    got = {r.doc_id: r.fingerprint & (2**64 - 1) for r in simhash.fingerprints(table).collect()}
    assert got == {i: plain_print(t) for i, t in enumerate(texts)}
    parts = list(simhash.shingle_hashes(b"one two three four five six", 3, part=5))
    assert np.concatenate(parts).tolist() == list(simhash.shingle_hashes(b"one two three four five six", 3))[0].tolist()


@pytest.mark.parametrize("most", [2, 64])
def test_links_of_dense_prints_equal_plain(spark, most):
    """Hundreds of prints in one block, in chains two bits apart and at three bits, joined by centres and by pairs."""
    pick = random.Random(4)
    values = {0, 2**64 - 1}
    for base in (0, pick.getrandbits(64), pick.getrandbits(64)):
        for _ in range(250):
            values.add(base ^ sum(1 << b for b in pick.sample(range(20), pick.choice([1, 2, 3, 4, 6]))))
    values |= {pick.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), most).collect()
    assert all(((e.a ^ e.b) & (2**64 - 1)).bit_count() <= 2 for e in edges)
    labels = {r.node: r.label for r in simhash.connected(
        spark.createDataFrame([(e.a, e.b) for e in edges], "a long, b long")).collect()}
    groups, plain = {}, plain_components([(i, v) for i, v in enumerate(values)])
    for v, s in zip(values, signed):
        groups.setdefault(labels.get(s, s), set()).add(plain[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(plain.values()))


def test_op13_equals_plain(spark):
    df = queries.op13_simhash(spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in docs]
    component = plain_components(prints)
    assert sorted(map(tuple, df.collect())) == sorted((i, f"{p:016x}", component[p]) for i, p in prints)


def test_simhash_of_nulls_and_nothing(spark):
    rows = [(None, "a b c"), (3, "A B C"), (4, None), (None, ""), (5, "q"), (None, "z z z z"), (3, "a b c")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("least", F.lit(1)).withColumn("label", F.lit(2))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(table).collect()), key=str)
    assert got == sorted([(None, 3), (3, 3), (3, 3), (4, 4), (None, 4), (5, 5), (None, None)], key=str)
    assert simhash.near_duplicates(table.where("false")).count() == 0


# ---- components ----


def test_components_of_stars_chains_and_more_edges(spark):
    from hirelens.llm import components

    pick = random.Random(9)
    names = pick.sample(range(-10**12, 10**12), 700)
    edges = [(names[0], n) for n in names[1:200]] + list(zip(names[200:500], names[201:501])) + [(names[600], names[600])]
    more = [(names[150], names[320]), (names[650], names[651]), (names[651], names[5])]
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labels = components.connected(table(edges))
    groups = lambda labels: sorted(
        sorted(n for n, l in rows if l == label) for rows in [[(r.node, r.label) for r in labels.collect()]]
        for label in {l for _, l in rows})
    assert groups(labels) == sorted([sorted(names[:200]), sorted(names[200:501])])
    after = components.joined(labels, table(more))
    assert groups(after) == [sorted(names[:501] + names[650:652])]
    assert components.joined(components.connected(table([])), table(more)).count() == 5


# ---- buckets, files and samples of earlier operators ----


def test_long_repeated_records_spread_over_buckets(spark, tmp_path, monkeypatch):
    """Copies of a long record fill no bucket alone, short rows stay where they were, and shards are written in order."""
    from hirelens.llm import sharding

    rows = [(7, "x" * 2000)] * 300 + [(i, f"t{i}") for i in range(500)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = []
    plain = sharding._second_pass
    monkeypatch.setattr(sharding, "_second_pass", lambda scattered, *a: seen.append(scattered) or plain(scattered, *a))
    out = sharding.shuffle_shards(table, 4, F.length("text"), bucket_bytes=60_000)
    largest = seen[0].groupBy("__bucket").agg(F.sum("__size").alias("b")).agg(F.max("b")).first()[0]
    assert largest < 3 * 60_000
    sharding.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select("doc_id", "text").collect())) == sorted(rows)
    for shard in range(4):
        slots = []
        for path in sorted((tmp_path / "s" / f"shard={shard}").glob("*.parquet")):
            slots += [r.slot for r in spark.read.parquet(str(path)).collect()]
        assert slots == list(range(200))


def test_cosine_of_very_long_and_short_vectors(spark):
    from hirelens.llm import forest

    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [5e-324, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in forest.nearest(table, lambda v: v < 5).collect()}
    half = 2 ** -0.5
    expected = {(0, 1): 1, (0, 2): half, (0, 3): half, (0, 4): 1, (2, 3): 1, (2, 4): half, (3, 4): half}
    assert all(abs(got[k] - v) < 1e-12 for k, v in expected.items()) and len(got) == 20


def test_language_sample_ignores_other_texts(spark):
    """The sample of a language is its least rows, repeats included, whatever the number of partitions."""
    from hirelens.llm import langid

    rows = [("aa", i * 37 % 101, f"text {i}") for i in range(90)] + [("bb", 5, "same")] * 40
    table = spark.createDataFrame(rows, "lang string, order long, text string").withColumn("mark", F.xxhash64("text"))
    for parts in (1, 7):
        got = sorted((r.lang, r.order) for r in langid.least_rows(table.repartition(parts), 20).collect())
        assert got == sorted([("aa", o) for o in sorted(r[1] for r in rows[:90])[:20]] + [("bb", 5)] * 20)


# ---- licences ----


def test_whole_licences_in_several_layouts(spark):
    from hirelens.llm import licences as L

    wrap = lambda t, n: re.sub(f"(.{{{n}}}[^ ]*) ", r"\1\n", t)
    mit, bsd = dict((t[:4], t) for _, t in L.KNOWN)["MIT "], next(t for n, t in L.KNOWN if n == "BSD-3-Clause")
    cases = {
        "MIT License Copyright (c) 2020 Ada Byron " + L._MIT_GRANT: "MIT",
        "MIT License\n\nCopyright (c) 2020-2024 Ada Byron, Inc. <a@b.org>\n\n" + wrap(L._MIT_GRANT, 70): "MIT",
        "mit license\r\n© 2020 X. All rights reserved.\r\n" + L._MIT_GRANT.upper().replace("SUBLICENSE", "SUB-LICENSE"): "MIT",
        "Copyright 2019 The Authors. All Rights Reserved.\n" + wrap(bsd, 40): "BSD-3-Clause",
        "BSD 2-Clause License\nCopyright (c) 2001, X\n" + L._BSD_GRANT + L._BSD_AS_IS: "BSD-2-Clause",
        wrap(L._UNLICENSE, 60): "Unlicense", L._ZLIB: "Zlib",
        "ISC Licence\nCopyright (c) 1995 Y\n" + L._ISC_GRANT + L._ISC_AS_IS: "ISC",
        mit + " One more clause.": None, "MIT License": None, "": None,
        "x All rights reserved y important text": None,
    }
    table = spark.createDataFrame([(t,) for t in cases], "text string")
    rows = {r.text: r for r in L.find_licences(table).collect()}
    assert {t: rows[t].licence for t in cases} == cases
    digests = {r.digest for t, r in rows.items() if cases[t] is None}
    assert len(digests) == sum(v is None for v in cases.values())


def test_licences_of_a_folder(spark, tmp_path):
    from pathlib import Path

    from hirelens.llm import licences as L

    folder = Path("/usr/share/common-licenses")
    if not (folder / "GPL-3").exists():
        pytest.skip("no folder of licence texts here")
    for name in ("GPL-3", "Apache-2.0", "MPL-2.0", "LGPL-2.1", "CC0-1.0"):
        (tmp_path / f"{name}.txt").write_text((folder / name).read_text(encoding="utf-8"), encoding="utf-8")
    more = L.folder_digests(spark, str(tmp_path))
    texts = {name: " ".join((folder / name).read_text(encoding="utf-8").split()) for name in ("MPL-2.0", "CC0-1.0")}
    table = spark.createDataFrame([(n, t.upper()) for n, t in texts.items()], "name string, text string")
    assert {r.name: r.licence for r in L.find_licences(table, more=more).collect()} == {n: n for n in texts}


def test_lines_of_licences_need_no_pass_of_their_own(spark):
    """Lines cut out of the normalised text are those normalised one by one; the text joins them."""
    from hirelens.llm import licences

    texts = [
        "Copyright (c) 2020 A\nMIT LICENCE & B", "© 2019 Foo permission x", "copyright 2020\n\ncopyright (c) 2021-2022 bar",
        "", "\n\n a \n", "hthttps://tp://x https://y", "ΑΣ\nΣΑΣ b", "and/or&and/or", "copyright 1999 x\r\ny", "a\u0085b",
        "all rights reserved.\n", "copyright (c) 2001 " + "z" * 300 + "\nk", "(c) 2004, 2005 - 2006\n2007", "😀\n中文。中"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    parts = F.transform(F.split(licences.canonical_lines(F.col("text")), "\n"), lambda p: F.trim(p))
    found = rows.select("text", parts.alias("parts"), licences.canonical(F.col("text")).alias("whole")).collect()
    alone = spark.createDataFrame([(p,) for t in texts for p in t.split("\n")], "line string").distinct()
    by_line = dict(alone.select("line", licences.canonical(F.col("line"))).collect())
    for r in found:
        assert r.parts == [by_line[p] for p in r.text.split("\n")]
        assert r.whole == " ".join(p for p in r.parts if p)
    assert found[0].whole == "mit license and b" and found[5].whole == "http x y"
