"""Packing token pieces into fixed-length sequences by cutting-stock column generation.

Documents are tokenized in one Arrow pass and cut into full sequences and one rest. The lengths are counted in classes
of a few tokens; a linear program over packing patterns of that histogram is solved by column generation, its columns
priced by knapsack dynamic programming, and the rounded patterns are dealt to the ranked pieces of each class.
Only the histogram (its size is fixed by the sequence length) is solved on the driver.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import slices, store

END_ID = 1
BETWEEN = re.compile(r"(?<=\w)[ \n]")  # a blank after a word character always starts another token


class Encoder:
    """Encodes texts as little-endian 32-bit ids of a vocabulary that both libraries have.

    Texts of Latin-1 characters, on which the two agree (tested), go to the faster one. Strings of special tokens are
    ordinary text. A text of more than ``part`` characters is encoded in parts that end where every token ends. A
    part that is much longer, because a run of blanks or letters has no such place, is cut by the first library's own
    splitter, and each of its cuts is merged on its own, as both libraries do; that takes memory in proportion to the
    run, and no backtracking.
    """

    def __init__(self, vocabulary: str, part: int = 100_000):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.part = part
        self.model = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.model.encode_special_tokens = True
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.merge = tiktoken.Encoding(  # takes all it gets for one token candidate
            f"{vocabulary}-whole", pat_str=r"(?s:.)++", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if len(text) <= self.part:
            return self._encode_part(text)
        out, low = [], 0
        while low < len(text):
            cut = BETWEEN.search(text, low + self.part)
            high = cut.start() if cut else len(text)
            out.append(self._encode_part(text[low:high]))
            low = high
        return b"".join(out)

    def _encode_part(self, text: str) -> bytes:
        if len(text) > 2 * self.part:
            cuts = self.model.pre_tokenizer.pre_tokenize_str(text)
            return b"".join(self._bytes(self.merge.encode_to_numpy(text[a:b])) for _, (a, b) in cuts)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._bytes(np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32))
        return self._bytes(self.fast.encode_to_numpy(text))

    @staticmethod
    def _bytes(ids: np.ndarray) -> bytes:
        return ids.astype("<u4", copy=False).tobytes()


def token_pieces(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k", length: int = 2048, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids.

    A document is its ids and ``END_ID``; a null text is empty. Pieces are cut every ``length`` ids. Texts of any
    length are encoded whole, in parts; repeated rows are documents of their own. Only doc_id and text are read.
    """
    fields = [("doc_id", docs.schema["doc_id"].dataType.simpleString())]
    fields += [("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint")]
    fields += [("ids", "binary")] if keep_ids else []
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in fields]
            rows: list[int] = []
            for row, text in enumerate(batch.column("text")):
                ids = encoder.encode(text.as_py() or "") + end
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at:at + 4 * length]
                    rows.append(row)
                    for column, value in zip(out[1:], (at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece)):
                        column.append(value)
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in out[1:5]]
            columns += [pa.array(out[5], pa.binary())] if keep_ids else []
            yield pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, ", ".join(f"{n} {t}" for n, t in fields))


def priced_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack over class sizes 1 to capacity (values[c - 1])."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gains = best[room - 1::-1][:room] + values[:room]
        k = int(np.argmax(gains))
        if gains[k] > best[room - 1] + 1e-15:
            best[room], took[room] = gains[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern = np.zeros(capacity, np.int64)
    room = capacity
    while room > 0:
        if took[room]:
            pattern[took[room] - 1] += 1
            room -= took[room]
        else:
            room -= 1
    return float(best[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering the demand of every class.

    Revised simplex on the restricted master program; a column enters while its value exceeds one sequence. The
    program stops within a ten-thousandth of its bound. What rounding down leaves is packed largest first.
    """
    used = np.flatnonzero(demand > 0)
    if not len(used):
        return []
    m = len(used)
    columns = np.zeros((m, capacity), np.int64)
    columns[np.arange(m), used] = capacity // (used + 1)
    inverse = np.diag(1.0 / columns[np.arange(m), used])
    need = demand[used].astype(float)
    amount = inverse @ need
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        values = np.zeros(capacity)
        values[used] = np.maximum(duals, 0)
        worth, pattern = priced_pattern(values, capacity)
        if worth <= 1 + 1e-9 or amount.sum() <= 1.0001 * (need @ values[used]) / worth:
            break
        step = inverse @ pattern[used].astype(float)
        positive = step > 1e-12
        if not positive.any():
            break
        ratio = np.full(m, np.inf)
        ratio[positive] = amount[positive] / step[positive]
        out = int(np.argmin(ratio))
        move = max(ratio[out], 0.0)
        amount = np.maximum(amount - move * step, 0)
        amount[out] = move
        columns[out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    plan: dict[bytes, int] = {}
    left = demand.astype(np.int64).copy()
    for pattern, times in zip(columns, np.floor(amount + 1e-9).astype(np.int64)):
        if times > 0:
            key = pattern.tobytes()
            plan[key] = plan.get(key, 0) + int(times)
            left -= pattern * times
    left = np.maximum(left, 0)
    while left.any():
        room, pattern = capacity, np.zeros(capacity, np.int64)
        for c in np.flatnonzero(left)[::-1]:
            n = min(int(left[c]), room // int(c + 1))
            pattern[c] += n
            room -= n * int(c + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan[pattern.tobytes()] = plan.get(pattern.tobytes(), 0) + times
        left -= pattern * times
    return [(np.frombuffer(key, np.int64), times) for key, times in plan.items()]


def class_places(plan: list[tuple[np.ndarray, int]], capacity: int) -> list[tuple]:
    """Per class: ranks at which a pattern begins, its first sequence and its places for the class."""
    places: dict[int, tuple[list, list, list]] = {}
    at, sequence = np.zeros(capacity, np.int64), 0
    for pattern, times in plan:
        for c in np.flatnonzero(pattern):
            starts, firsts, counts = places.setdefault(int(c) + 1, ([], [], []))
            starts.append(int(at[c]))
            firsts.append(sequence)
            counts.append(int(pattern[c]))
            at[c] += times * pattern[c]
        sequence += times
    return [(c, *lists) for c, lists in sorted(places.items())]


def pack(pieces: DataFrame, length: int = 2048, unit: int = 8, rows_per_range: int = 50_000) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences hold at most ``length`` ids.

    Stores the pieces and counts their lengths when called. Pieces of a class are ranked in ranges of a hash of their
    stored number, so that a class with most pieces is not one task. Empty input gives an empty result.
    """
    capacity = length // unit
    numbered = pieces.withColumn("__class", F.ceil(F.col("length") / unit).cast("int"))
    numbered = store(numbered.withColumn("__no", F.monotonically_increasing_id()), "pieces")
    histogram = {r[0]: r[1] for r in numbered.groupBy("__class").count().collect()}  # at most `capacity` rows
    demand = np.zeros(capacity, np.int64)
    for c, n in histogram.items():
        demand[c - 1] = n
    places = class_places(cutting_stock(demand, capacity), capacity)
    ranges = max(1, int(demand.sum()) // rows_per_range)
    numbered = numbered.withColumn("__range", F.pmod(F.xxhash64("__no"), F.lit(ranges)))

    before = Window.partitionBy("__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("__class", "__range").count().select(
        "__class", "__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__class", "__range").orderBy("__no")
    ranked = numbered.withColumn("__rank", F.row_number().over(within) - 1).join(starts, ["__class", "__range"])
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("__before"))

    spark = pieces.sparkSession
    schema = "__class int, __starts array<bigint>, __firsts array<bigint>, __counts array<bigint>"
    lookup = F.broadcast(spark.createDataFrame(places, schema))  # one row per class, at most `capacity`
    placed = ranked.join(lookup, "__class").withColumn(
        "__at", F.size(F.filter("__starts", lambda s: s <= F.col("__rank"))))
    placed = placed.withColumn("sequence_id", F.expr(
        "element_at(__firsts, __at) + (__rank - element_at(__starts, __at)) div element_at(__counts, __at)"))
    earlier = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "__no")
               .rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    return placed.select(*pieces.columns, "sequence_id", "offset")
