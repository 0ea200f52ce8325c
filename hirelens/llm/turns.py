"""Conversation structure repair by a square-root checkpointed dynamic program.

A conversation is repaired to role initials ``(s?(ua)+)?`` by the cheapest edits: Keep 0, Rerole to user or assistant 2,
Delete 3 (the only choice for blank and repeated turns), Insert an empty turn of user or assistant 2; a truncated turn
that stays costs 1 more. Among equally cheap edits the ASCII-least string of initials wins, so the walk from the front
takes the least letter whose cost is tight.

States of the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a. The vector of a place holds, per state, the least
cost of all that follows. Vectors are kept only at checkpoints; the walk works out a block anew from the checkpoint at
its end. This happens twice: rows lie in cells of about the square root of the table, and in a cell in blocks of the
square root of a run. A conversation that lies in several cells (it may hold a third of all rows) is solved in
parallel: each cell tells its run as a matrix of costs from state to state, the matrices give the vector at the end of
each run, the runs tell which state they turn each state into, and these give each run its first state.

Equal rows of one turn are one unit with a count: all but the first are repeats and deleted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 60
END = (0, 2 * INSERT, INSERT, 0)
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}  # state after keeping, by state
OTHER = (None,) * 4
MADE = (2, 2, 3, 2)  # state after a turn whose role is chosen
ROLES = {2: "user", 3: "assistant"}
FOLLOWS = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"

Unit = tuple[bool, bool, str, int]  # to be deleted, truncated, initial, count
Vector = tuple[int, int, int, int]


def before_unit(unit: Unit, after: Vector) -> Vector:
    """The vector in front of a unit."""
    bad, cut, initial, count = unit
    rest = DELETE * (count - 1)
    if bad:
        rest += DELETE
        return after[0] + rest, after[1] + rest, after[2] + rest, after[3] + rest
    kept = KEPT.get(initial, OTHER)
    x = []
    for state in range(4):
        least = min(DELETE + after[state], REROLE + cut + after[MADE[state]])
        if kept[state] is not None:
            least = min(least, KEEP + cut + after[kept[state]])
        x.append(least + rest)
    two, three = min(x[2], INSERT + x[3]), min(x[3], INSERT + x[2])
    return min(x[0], INSERT + two), min(x[1], INSERT + two), two, three


def matrix(units: list[Unit]) -> list[int]:
    """Least costs of a run from each state (rows) to each state (columns)."""
    columns = []
    for state in range(4):
        vector = tuple(0 if s == state else NEVER for s in range(4))
        for unit in reversed(units):
            vector = before_unit(unit, vector)
        columns.append(vector)
    return [min(columns[to][state], NEVER) for state in range(4) for to in range(4)]


def walk(units: list[Unit], end: Vector, state: int) -> Iterator[tuple[str, list[str], bool, str | None, int, int]]:
    """Per unit: initials of its edits, roles inserted before it, whether it stays, its new role, cost, state after it.

    Checkpoints are a square root of the run apart; the vectors of a block are worked out anew when the walk enters it.
    """
    size = math.isqrt(max(len(units) - 1, 0)) + 1
    marks, vector = {}, end
    for i in range(len(units) - 1, -1, -1):
        if (i + 1) % size == 0 or i + 1 == len(units):
            marks[i + 1] = vector
        vector = before_unit(units[i], vector)
    for low in range(0, len(units), size):
        high = min(low + size, len(units))
        vectors = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(before_unit(units[i], vectors[-1]))
        for i in range(low, high):
            yield (step := _edits(units[i], vectors[high - i], vectors[high - i - 1], state))
            state = step[5]


def _edits(unit: Unit, here: Vector, after: Vector, state: int) -> tuple[str, list[str], bool, str | None, int, int]:
    bad, cut, initial, count = unit
    rest = DELETE * (count - 1)
    if bad:
        return "D" * count, [], False, None, DELETE * count, state
    kept, letters, made, cost = KEPT.get(initial, OTHER), "", [], rest
    while here[state] != DELETE + rest + after[state]:  # the least letter would delete
        to = MADE[state]
        if here[state] == INSERT + here[to]:
            letters, cost, state = letters + "I", cost + INSERT, to
            made.append(ROLES[to])
            continue
        if kept[state] is not None and here[state] == KEEP + cut + rest + after[kept[state]]:
            return letters + "K" + "D" * (count - 1), made, True, None, cost + KEEP + cut, kept[state]
        return letters + "R" + "D" * (count - 1), made, True, ROLES[to], cost + REROLE + cut, to
    return letters + "D" * count, made, False, None, cost + DELETE, state


def tail(state: int) -> list[str]:
    """Roles inserted after the last turn."""
    return {1: ["user", "assistant"], 2: ["assistant"]}.get(state, [])


def keyed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with their identity: ``unit`` of the row, ``said`` of role and text.

    A null role or text counts as one space.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    told = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c)), F.lit("-"))
    # half of a SHA-256 tells rows apart and sorts them as the whole would
    half = lambda c: F.substring(F.unhex(F.sha2(c, 256)), 1, 16)
    rows = rows.withColumn("said", half(F.concat(F.length("role"), F.lit(":"), "role", "text")))
    return rows.withColumn("unit", half(F.concat(told("conv_id"), told("turn"), F.hex("said"))))


def ordered_units(rows: DataFrame, per_cell: int) -> DataFrame:
    """Units of all conversations in order, with their place ``at`` and the ``cell`` they lie in.

    The order is conversation, turn (nulls first), and within a turn a digest of role and text. Ranges of that order
    are the partitions, so that a long conversation lies in several.
    """
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    blank = last == ""
    facts = rows.select("unit", "conv_id", "turn", "said", F.left("role", F.lit(1)).alias("initial"),
                        blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("cut"))
    names = ["conv_id", "turn", "said", "initial", "blank", "cut"]
    units = facts.groupBy("unit").agg(F.count("*").alias("count"), *[F.first(c).alias(c) for c in names])
    units = store(units, "units")
    first = units.groupBy("conv_id", "said").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn", "unit"))["unit"].alias("unit"))
    units = units.join(first.select("unit", F.lit(True).alias("first")), "unit", "left")
    units = units.withColumn("again", F.col("first").isNull() & ~F.col("blank")).drop("first")
    cell = max(per_cell, math.isqrt(units.count()))
    order = ["conv_id", "turn", "said"]
    units = units.repartitionByRange(*order).sortWithinPartitions(*order)
    units = units.withColumn("at", F.monotonically_increasing_id())
    return store(units.withColumn("cell", F.floor(F.col("at") / cell)), "ordered")


def _runs(table: pa.Table) -> tuple[pa.Table, list[Unit], list[tuple[int, int]]]:
    """The units of a cell in order, as a table and as tuples, and the ranges that belong to one conversation."""
    table = table.combine_chunks().sort_by("at")
    column = lambda c: table.column(c).to_pylist()
    units = [(blank or again, cut, initial, count) for blank, again, cut, initial, count in zip(
        column("blank"), column("again"), column("cut"), column("initial"), column("count"))]
    ids = column("conv_id")
    starts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
    return table, units, list(zip(starts, [*starts[1:], len(ids)]))


def spans(units: DataFrame) -> DataFrame:
    """Runs of conversations that lie in several cells: cell, conv_id, entry, end, last (initial before), more."""
    kind = units.schema["conv_id"].dataType.simpleString()

    def outer(table: pa.Table) -> pa.Table:
        table, units, runs = _runs(table)
        ends = sorted({0, len(runs) - 1})  # only the first and the last run may go on elsewhere
        return pa.table({
            "cell": table.column("cell").take(pa.array([runs[r][0] for r in ends])),
            "conv_id": table.column("conv_id").take(pa.array([runs[r][0] for r in ends])),
            "costs": pa.array([matrix(units[slice(*runs[r])]) for r in ends], pa.list_(pa.int64())),
            "closing": pa.array([units[runs[r][1] - 1][2] for r in ends], pa.string())})

    def backward(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("cell")
        n = table.num_rows if table.num_rows > 1 else 0  # the others lie in one cell
        ends, vector = [], END
        for costs in reversed(table.column("costs").to_pylist()[:n]):
            ends.append(list(vector))
            vector = tuple(min(costs[4 * s + t] + vector[t] for t in range(4)) for s in range(4))
        closing = table.column("closing").to_pylist()
        return pa.table({
            "cell": table.column("cell").slice(0, n), "conv_id": table.column("conv_id").slice(0, n),
            "end": pa.array(ends[::-1], pa.list_(pa.int64())), "last": pa.array([None, *closing[:-1]][:n], pa.string()),
            "more": pa.array([i + 1 < n for i in range(n)], pa.bool_())})

    def exits(table: pa.Table) -> pa.Table:
        table, units, _ = _runs(table)
        row = table.slice(0, 1)
        end = tuple(row.column("end")[0].as_py())
        after = []
        for state in range(4):
            for step in walk(units, end, state):
                state = step[5]
            after.append(state)
        return row.select(["cell", "conv_id", "end", "last", "more"]).append_column(
            "after", pa.array([after], pa.list_(pa.int32())))

    def forward(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("cell")
        entry, state = [], 0
        for after in table.column("after").to_pylist():
            entry.append(state)
            state = after[state]
        return table.drop_columns(["after"]).append_column("entry", pa.array(entry, pa.int32()))

    told = f"cell bigint, conv_id {kind}, end array<bigint>, last string, more boolean"
    costs = units.groupBy("cell").applyInArrow(outer, f"cell bigint, conv_id {kind}, costs array<bigint>, closing string")
    ends = store(store(costs, "costs").groupBy("conv_id").applyInArrow(backward, told), "ends")
    other = ends.select(F.col("cell").alias("its_cell"), F.col("conv_id").alias("its_conv"), "end", "last", "more")
    runs = units.join(other, _same_run()).drop("its_cell", "its_conv")
    runs = runs.groupBy("cell", "conv_id").applyInArrow(exits, f"{told}, after array<int>")
    return store(runs.groupBy("conv_id").applyInArrow(forward, f"{told}, entry int"), "spans")


def _same_run() -> Column:
    return (F.col("cell") == F.col("its_cell")) & F.col("conv_id").eqNullSafe(F.col("its_conv"))


EDITS = ("at bigint, unit binary, edits string, before array<string>, kept boolean, new_role string, "
         "after array<string>, cost bigint, blanks bigint, repeats bigint, truncated bigint, illegal bigint")


def unit_edits(units: DataFrame) -> DataFrame:
    """The edits of every unit of ``ordered_units``."""
    kind = {c: units.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    across = spans(units).select(
        F.col("cell").alias("its_cell"), F.col("conv_id").alias("its_conv"), "end", "last", "more", "entry")
    rows = units.join(across, _same_run(), "left").drop("its_cell", "its_conv")

    def edit(table: pa.Table) -> pa.Table:
        table, units, runs = _runs(table)
        column = lambda c: table.column(c).to_pylist()
        end, last, more, entry, blank = map(column, ("end", "last", "more", "entry", "blank"))
        out = []
        for low, high in runs:
            before = last[low]
            steps = walk(units[low:high], tuple(end[low] or END), entry[low] or 0)
            for i, (edits, made, kept, role, cost, state) in enumerate(steps, low):
                bad, cut, initial, count = units[i]
                repeats = 0 if blank[i] else count - (not bad)
                closing = tail(state) if i + 1 == high and not more[low] else []
                illegal = count - 1 + (before is not None and before + initial not in FOLLOWS)
                before = initial
                out.append((edits + "I" * len(closing), made, kept, role, closing, cost + INSERT * len(closing),
                            count if blank[i] else 0, repeats, int(cut and not bad), illegal))
        parts = list(zip(*out))
        kinds = (pa.string(), pa.list_(pa.string()), pa.bool_(), pa.string(), pa.list_(pa.string()), *[pa.int64()] * 5)
        names = ("edits", "before", "kept", "new_role", "after", "cost", "blanks", "repeats", "truncated", "illegal")
        made = {n: pa.array(p, k) for n, p, k in zip(names, parts, kinds)}
        return pa.table({"conv_id": table.column("conv_id"), "turn": table.column("turn"),
                         "at": table.column("at"), "unit": table.column("unit"), **made})

    return rows.groupBy("cell").applyInArrow(edit, f"conv_id {kind['conv_id']}, turn {kind['turn']}, {EDITS}")


def edited(turns: DataFrame, per_cell: int = 4096) -> DataFrame:
    """Every unit of every conversation (equal rows of a turn) with its edits, and role and text if it stays.

    Columns: conv_id, turn, at (order over all conversations), edits (initials, those of inserted turns included),
    before and after (roles of turns inserted around it), role and text (null if deleted), cost, and how many of its
    rows count as blanks, repeats (role and text seen earlier), truncated, and how many illegal neighbours end in it.

    ``turns`` has conv_id, turn, role and text; other columns are not read, whatever their names. A null role or text
    counts as one space, a null turn comes first, a null conv_id is a conversation of its own. Rows of one turn come in
    the order of a digest of role and text; repeated rows are repeats. Texts of any length are told by a digest until
    the end. An empty table gives no rows. ``turns`` should be a stored table, as it is read twice. Runs jobs when called.
    """
    rows = keyed(turns)
    edits = unit_edits(ordered_units(rows, per_cell))
    texts = rows.groupBy("unit").agg(F.first("role").alias("own_role"), F.first("text").alias("own_text"))
    return edits.join(texts, "unit").select(
        "conv_id", "turn", "at", "edits", "before", "after",
        F.when(F.col("kept"), F.coalesce("new_role", "own_role")).alias("role"),
        F.when(F.col("kept"), F.col("own_text")).alias("text"),
        "cost", "blanks", "repeats", "truncated", "illegal")


def repaired_turns(units: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, at and nth (their order), role, text."""
    made = lambda c: F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("role").isNull(), F.array()).otherwise(F.array(F.struct("role", "text")))
    rows = units.select("conv_id", "at", F.posexplode(F.concat(made("before"), own, made("after"))).alias("nth", "turn"))
    return rows.select("conv_id", "at", "nth", "turn.role", "turn.text")


REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


def report(units: DataFrame) -> DataFrame:
    """One row per conversation of ``edited``: its faults, cost, edits and the digest of its repaired turns.

    The rows of a conversation pass through one task in order, as a SHA-256 has to; they are streamed, and nothing but
    the initials of the edits (a column of the result) is kept of them.
    """
    kind = units.schema["conv_id"].dataType.simpleString()
    sums = ("blanks", "repeats", "truncated", "illegal", "cost")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def told(done: list) -> pa.RecordBatch:
            columns = [[d["conv_id"] for d in done],
                       [min(d["high"] - d["low"] + 1 - d["turns"], (1 << 63) - 1) if d["turns"] else 0 for d in done],
                       *[[d[s] for d in done] for s in sums],
                       ["".join(d["edits"]) for d in done], [d["sha"].hexdigest() for d in done]]
            kinds = [id_kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            done, id_kind = [], batch.schema.field("conv_id").type
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if now is None or now["conv_id"] != row["conv_id"]:
                        if now is not None:
                            done.append(now)
                        now = {"conv_id": row["conv_id"], "low": None, "high": None, "turns": 0, "edits": [],
                               "sha": hashlib.sha256(), "any": False, **dict.fromkeys(sums, 0)}
                    turn = row["turn"]
                    if turn is not None and (not now["turns"] or turn != now["high"]):
                        now["low"] = turn if not now["turns"] else now["low"]
                        now["high"], now["turns"] = turn, now["turns"] + 1
                    for s in sums:
                        now[s] += row[s]
                    now["edits"].append(row["edits"])
                    own = [(row["role"], row["text"])] if row["role"] is not None else []
                    for role, text in [*((r, "") for r in row["before"]), *own, *((r, "") for r in row["after"])]:
                        now["sha"].update(b"\n" * now["any"] + f"{role}:".encode())
                        now["sha"].update(text.encode())
                        now["any"] = True
            if done:
                yield told(done)
        if now is not None:
            yield told([now])

    rows = units.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return rows.select("conv_id", "turn", "edits", "before", "after", "role", "text", *sums).mapInArrow(
        tell, f"conv_id {kind}, {REPORT}")


def with_all(conversations: DataFrame, told: DataFrame) -> DataFrame:
    """``report`` rows of all conversations; those without a turn left have zeros and an empty audit."""
    told = told.withColumnRenamed("conv_id", "its_id")
    rows = conversations.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("its_id")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return rows.select("conv_id", *[
        F.coalesce(c, F.lit(none.get(c, 0))).cast(rows.schema[c].dataType).alias(c)
        for c in told.columns if c != "its_id"])


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by the checksum of ``conv_id:turn`` (a null is one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    rows = rows.withColumn("text", text).withColumn("copy", F.explode(copies))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), "text")
