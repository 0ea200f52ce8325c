"""SentencePiece encoding as a relational lattice, and decoding.

The words of all texts are counted. Frequent ones (their number is bounded by the reciprocal of the frequency) explode
into substrings of bounded length, which are equi-joined with the piece table; the edges of a word are grouped and a
higher-order aggregate folds them into the best path (Viterbi). These paths travel with the code. All other words get the
same lattice where they are met, once a task as far as it remembers: there are more of them, counted once a document,
than texts, so to send them to a table and their paths back would take several times the input.

A table made for merging pairs has ranks instead of probabilities. A piece's score is then the logarithm of the
probability that its rank has under Zipf's law, and the best path is the one of the largest sum. The table's own tool
merges pairs instead and may cut a word otherwise; either sequence decodes to the same text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import slices, store

BLANK = "▁"
WORDS = re.compile(f"{BLANK}*[^{BLANK}\n]{{1,200}}|{BLANK}{{1,200}}|\n")
BYTE_SCORE = -100.0  # a byte is taken only where no piece fits


def words_of(text: str) -> list[str]:
    """Words with their leading blanks; a word ends before a blank or line end, or after 200 characters."""
    return WORDS.findall(BLANK + text.replace(" ", BLANK)) if text else []


def piece_rows(vocabulary: str) -> list[tuple[int, str, float]]:
    """id, piece and score (logarithm, by rank) of the normal pieces of a vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    return [(i, model.id_to_piece(i), -math.log(i)) for i in range(3, model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def byte_ids(vocabulary: str) -> list[int]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    return [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def encoded_words(words: DataFrame, pieces: list[tuple[int, str, float]], bytes_: list[int],
                  part: int = 400_000) -> DataFrame:
    """word and ids of each distinct word (column ``word``).

    Words are dealt by word once, ``part`` characters to a partition; substrings, edges and paths of a word stay there.
    """
    spark = words.sparkSession
    longest = max(len(p) for _, p, _ in pieces)
    # The piece table has the fixed size of its vocabulary.
    table = F.broadcast(spark.createDataFrame(pieces, "id int, piece string, score double"))
    n = F.length("word")
    parts = (words.agg(F.sum(n)).first()[0] or 0) // part + 1
    start = words.select("word").repartition(parts, "word").select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("low"))
    spans = start.select("word", "low", F.explode(F.sequence(
        F.col("low") + 1, F.least(F.col("low") + longest, n))).alias("high"))
    spans = spans.withColumn("piece", F.expr("substring(word, low + 1, high - low)"))
    # a character that is no piece falls back to its bytes; minus its place stands for them until the path is known
    found = spans.join(table, "piece", "left").where("id is not null or high = low + 1")
    id_ = F.coalesce("id", -F.col("high"))
    score = F.coalesce("score", F.octet_length("piece") * F.lit(BYTE_SCORE))
    edges = found.groupBy("word").agg(F.sort_array(F.collect_list(F.struct(
        "high", "low", score.alias("score"), id_.alias("id")))).alias("edges"))
    # state: best scores and paths up to the last finished position; position, score and edge of the one in work
    zero = F.expr("named_struct('at', 0, 'top', 0D, 'low', 0, 'id', 0, 'best', cast(array() as array<double>), "
                  "'path', cast(array() as array<array<int>>))")
    none = F.expr("cast(array() as array<int>)")

    def state(at, top, low, id_, best, path) -> Column:
        return F.struct(at.alias("at"), top.alias("top"), low.alias("low"), id_.alias("id"),
                        best.alias("best"), path.alias("path"))

    def finished(acc: Column) -> Column:
        """Path of the position in work."""
        own = F.concat(F.element_at(acc["path"], acc["low"] + 1), F.array(acc["id"]))
        return F.when(acc["at"] == 0, none).otherwise(own)

    def step(acc: Column, e: Column) -> Column:
        before = F.when(e["low"] == acc["at"], acc["top"]).otherwise(F.element_at(acc["best"], e["low"] + 1))
        score = before + e["score"]
        moved = state(e["high"], score, e["low"], e["id"], F.concat(acc["best"], F.array(acc["top"])),
                      F.concat(acc["path"], F.array(finished(acc))))
        better = state(acc["at"], score, e["low"], e["id"], acc["best"], acc["path"])
        return F.when(e["high"] != acc["at"], moved).when(score > acc["top"], better).otherwise(acc)

    paths = edges.select("word", F.aggregate("edges", zero, step, finished).alias("ids"))
    code = F.lit(bytes_)

    def raw(place: Column) -> Column:
        char = F.substring("word", place, F.lit(1))
        hexed = F.hex(F.encode(char, "utf-8"))
        return F.transform(F.sequence(F.lit(1), F.octet_length(char)), lambda i: F.element_at(
            code, F.conv(F.substring(hexed, i * 2 - 1, F.lit(2)), 16, 10).cast("int") + 1))

    whole = F.flatten(F.transform("ids", lambda i: F.when(i >= 0, F.array(i)).otherwise(raw(-i))))
    return paths.select("word", F.when(F.array_min("ids") < 0, whole).otherwise(F.col("ids")).alias("ids"))


class Lattice:
    """The lattice of :func:`encoded_words` inside a task, for many words at a time.

    The piece table is kept as the sorted prefixes of its pieces; every place of every word is joined with them one
    character longer at a time, and edges are folded in the order of :func:`encoded_words`, so ties fall alike.
    """

    def __init__(self, pieces: list[tuple[int, str, float]], bytes_: list[int]):
        nodes, keys = {"": 0}, []
        for _, piece, _ in pieces:
            for end in range(1, len(piece) + 1):
                if nodes.setdefault(piece[:end], len(nodes)) == len(keys) + 1:
                    keys.append(nodes[piece[:end - 1]] << 21 | ord(piece[end - 1]))
        order = np.argsort(keys)
        self.keys, self.child = np.array(keys, np.int64)[order], order + 1
        self.id, self.score = np.full(len(nodes), -1), np.zeros(len(nodes))
        at = [nodes[piece] for _, piece, _ in pieces]
        self.id[at], self.score[at] = [i for i, _, _ in pieces], [score for _, _, score in pieces]
        self.bytes = np.array(bytes_)

    def edges(self, codes: np.ndarray, room: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        """First place, length, score and id (-1: its bytes) of the edges that begin at ``low`` to ``high``.

        ``room`` is what is left of the word of each place.
        """
        at = np.arange(low, high)
        node, found = np.zeros(len(at), np.int64), []
        for length in range(1, int(room[low:high].max()) + 1):
            if length > 1:
                inside = room[at] >= length
                at, node = at[inside], node[inside]
            if not len(at):
                break
            key = node << 21 | codes[at + length - 1]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            node = np.where(hit, self.child[place], 0)
            piece = self.id[node] >= 0
            if length == 1:
                found.append((at[~piece], 1, _octets(codes[at[~piece]]) * BYTE_SCORE, np.full((~piece).sum(), -1)))
            found.append((at[piece], length, self.score[node[piece]], self.id[node[piece]]))
            at, node = at[hit], node[hit]
        return (np.concatenate([x[0] for x in found]), np.repeat([x[1] for x in found], [len(x[0]) for x in found]),
                np.concatenate([x[2] for x in found]), np.concatenate([x[3] for x in found]))

    def paths(self, words: list[str], part: int = 50_000) -> Iterator[bytes]:
        """The ids of each word as bytes; edges of about ``part`` places are held at a time, also of a longer word."""
        low = 0
        ends = np.cumsum([len(w) for w in words])
        while low < len(words):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + part, "right")))
            yield from self._paths(words[low:high], part)
            low = high

    def _paths(self, words: list[str], part: int) -> list[bytes]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        begins = np.concatenate([[0], ends[:-1]])
        word = np.repeat(np.arange(len(words)), ends - begins)
        room = ends[word] - np.arange(len(codes))
        starts = begins + np.arange(len(words))  # a word has one place more than characters
        places = len(codes) + len(words)
        best, before, piece = np.full(places, -np.inf), np.zeros(places, np.int64), np.zeros(places, np.int64)
        best[starts] = 0
        for low in range(0, len(codes), part):
            first, length, score, id_ = self.edges(codes, room, low, min(low + part, len(codes)))
            # by the place in its word where an edge ends, the longest first
            end = first - begins[word[first]] + length
            rank = end * (int(length.max()) + 1) - length
            order = np.argsort(rank.astype(np.min_scalar_type(int(rank.max()))), kind="stable")  # small numbers sort fast
            first, length, score, id_, end = (x[order] for x in (first, length, score, id_, end))
            tail = first + word[first]
            head = tail + length
            new = np.flatnonzero((end[1:] != end[:-1]) | (length[1:] != length[:-1])) + 1
            if 16 * len(new) < len(first):
                for a, b in zip([0, *new], [*new, len(first)]):  # edges that end in different words
                    top = best[tail[a:b]] + score[a:b]
                    better = np.flatnonzero(top > best[head[a:b]])
                    at = head[a + better]
                    best[at], before[at], piece[at] = top[better], tail[a + better], id_[a + better]
            else:  # few or long words
                a, b = int(tail.min()), int(head.max()) + 1
                tops, taken = best[a:b].tolist(), [-1] * (b - a)
                for e, (t, h, s) in enumerate(zip((tail - a).tolist(), (head - a).tolist(), score.tolist())):
                    if tops[t] + s > tops[h]:
                        tops[h], taken[h] = tops[t] + s, e
                best[a:b], taken = tops, np.array(taken)
                at = np.flatnonzero(taken >= 0)
                before[a + at], piece[a + at] = tail[taken[at]], id_[taken[at]]
        begun = np.zeros(places, bool)
        begun[starts] = True
        at, heads = starts + ends - begins, []
        while len(at):
            heads.append(at)
            at = before[at]
            at = at[~begun[at]]
        heads = np.sort(np.concatenate(heads))
        owner = np.searchsorted(starts, heads, "right") - 1
        first, ids = before[heads] - owner, piece[heads]
        bare = ids < 0
        count = np.where(bare, _octets(codes[first]), 1)
        out = np.repeat(ids, count)
        raw = codes[first[bare]].astype("<u4").tobytes().decode("utf-32-le").encode()
        out[np.repeat(bare, count)] = self.bytes[np.frombuffer(raw, np.uint8)]
        cuts = 4 * np.cumsum(np.bincount(owner, count, len(words))).astype(np.int64)
        flat = out.astype("<i4").tobytes()
        return [flat[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]


def _octets(codes: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


def word_counts(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """word and count over all texts; tasks count in memory and send what they have when it grows too large."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        send = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        for batch in slices(batches, "text"):
            for text in batch.column("text"):
                seen.update(words_of(text.as_py() or ""))
            if len(seen) > most:
                yield send()
                seen.clear()
        yield send()

    found = docs.select("text").mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def encode(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", frequent: float = 4e-6,
           remember: int = 2_000_000) -> DataFrame:
    """``docs`` with ``ids``; a null or empty text has none. Runs jobs when called.

    Words that make up ``frequent`` of all words or more travel with the code: 1 / ``frequent`` words at most. A task
    remembers the paths of other words up to about ``remember`` characters. Neither number changes the result.
    """
    kept = [c for c in docs.columns if c != "ids"]
    rows, code = piece_rows(vocabulary), byte_ids(vocabulary)
    counts = store(word_counts(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = encoded_words(counts.where(F.col("n") >= max(2, frequent * total)), rows, code).collect()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({r["word"]: np.array(r["ids"], "<i4").tobytes() for r in often})
    folds = context.broadcast(Lattice(rows, code))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lattice, held = dict(shared.value), folds.value, 0
        for batch in slices(batches, "text"):
            if held > remember:
                known, held = dict(shared.value), 0
            texts = [words_of(text.as_py() or "") for text in batch.column("text")]
            met = [w for w in set(chain.from_iterable(texts)) if w not in known]
            known.update(zip(met, lattice.paths(met)))
            held += sum(map(len, met))
            ids = [np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4") for words in texts]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.ListArray.from_arrays(pa.array(ends), flat)], [*kept, "ids"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept).mapInArrow(fill, f"{schema}, ids array<int>")


def decoded(ids: Column, vocabulary: str = "piece_bpe_32k.model") -> Column:
    """The text of a sequence of ids; unknown ids decode to nothing."""
    by_id = {i: p.replace(BLANK, " ").encode() for i, p, _ in piece_rows(vocabulary)}
    by_id |= {i: bytes([b]) for b, i in enumerate(byte_ids(vocabulary))}
    table = F.lit([by_id.get(i, b"").hex() for i in range(max(by_id) + 1)])
    joined = F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit(""))), "")
    text = F.decode(F.unhex(joined), "utf-8")
    return F.when(text.startswith(" "), F.substring(text, F.lit(2), F.length(text))).otherwise(text)
