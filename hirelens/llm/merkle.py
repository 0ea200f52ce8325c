"""Merkle fingerprints of documents: leaves under paragraphs under sections under a root.

A section ends with a blank line, a paragraph with a line end, a leaf with a sentence end or after 48 characters
without one. The pieces of each level cover the whole text, so that roots are equal for equal texts only, and the
leaves of differing branches tell where an edit lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION = r"(?s).+?(?:\n[ \t\r]*\n|\z)"
PARAGRAPH = r"[^\n]*\n+|[^\n]+"
LEAF = r"[^.!?\n]{1,48}[.!?\n]*|[.!?\n]+"
DIGEST = 12  # hexadecimal digits kept of a leaf's hash


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def fingerprint(text: Column) -> Column:
    """``root:leaf,leaf;leaf|leaf`` with ``,`` between leaves, ``;`` between paragraphs and ``|`` between sections.

    A node's digest is the SHA-256 of its children's digests, a leaf's that of its text. A null text is empty; the
    empty text has a root and no leaves.
    """
    leaf = lambda x: F.sha2(x, 256)
    sections = F.transform(_all(F.coalesce(text, F.lit("")), SECTION), lambda s: F.transform(
        _all(s, PARAGRAPH), lambda p: F.transform(_all(p, LEAF), leaf)))
    roots = F.transform(sections, lambda s: F.sha2(F.concat_ws(
        "", F.transform(s, lambda p: F.sha2(F.concat_ws("", p), 256))), 256))
    shown = F.array_join(F.transform(sections, lambda s: F.array_join(F.transform(
        s, lambda p: F.array_join(F.transform(p, lambda x: F.substring(x, 1, DIGEST)), ",")), ";")), "|")
    return F.concat(F.sha2(F.concat_ws("", roots), 256), F.lit(":"), shown)


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def leaves(print_: Column) -> Column:
    """All leaf digests in order."""
    return F.filter(F.split(F.substring_index(print_, ":", -1), "[,;|]"), lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves that both have (Dice), 0 if either has none."""
    x, y = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    total = F.size(x) + F.size(y)
    shared = F.when(total > 0, 2.0 * F.size(F.array_intersect(x, y)) / total).otherwise(0.0)
    # different roots are never wholly alike, even where one has the other's leaves in another order
    return F.when(root(a) == root(b), 1.0).otherwise(F.least(shared, F.lit(1.0 - 1e-9)))


def differing(a: Column, b: Column) -> Column:
    """Where a and b differ: ordered structs of change, section, paragraph, leaf (from 0) and digest.

    The walk goes down from the roots. Sections, then paragraphs, then leaves are aligned: equal ones at both ends fall
    away; between them, those at the same place are compared and unequal ones walked into. A leaf is ``changed`` (the
    path and digest of ``a``), ``removed`` (of ``a``, without a partner in ``b``) or ``inserted`` (of ``b``, without a
    partner in ``a``). A branch is told from another by the digests of all its leaves. Equal roots have no differences.
    """
    none = F.expr("cast(array() as array<string>)")

    def children(node: Column, by: str) -> Column:
        return F.when(node.isNull() | (node == ""), none).otherwise(F.split(node, by))

    def ends(x: Column, y: Column) -> Column:
        """Numbers of equal children at the beginning and, of the others, at the end."""
        least = F.least(F.size(x), F.size(y))
        run = lambda u, v, most: F.aggregate(
            F.arrays_zip(F.slice(u, F.lit(1), most).alias("u"), F.slice(v, F.lit(1), most).alias("v")),
            F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
            lambda acc, p: F.struct((acc["n"] + (acc["on"] & (p["u"] == p["v"])).cast("int")).alias("n"),
                                    (acc["on"] & (p["u"] == p["v"])).alias("on")), lambda acc: acc["n"])
        head = run(x, y, least)
        return F.struct(head.alias("head"), run(F.reverse(x), F.reverse(y), least - head).alias("tail"))

    def walk(x: Column, y: Column, visit) -> Column:
        """What ``visit`` gives for each pair of children that differ; a missing partner is null."""
        e = ends(x, y)
        pairs = F.transform(F.array(e), lambda e: F.zip_with(
            F.slice(x, e["head"] + 1, F.size(x) - e["head"] - e["tail"]),
            F.slice(y, e["head"] + 1, F.size(y) - e["head"] - e["tail"]),
            lambda u, v: F.struct(u.alias("u"), v.alias("v"), e["head"].alias("head"))))
        found = F.transform(F.element_at(pairs, 1), lambda p, i: F.struct(p["u"].alias("u"), p["v"].alias("v"), (p["head"] + i).alias("at")))
        return F.transform(F.filter(found, lambda p: ~p["u"].eqNullSafe(p["v"])), visit)

    def leaf(section: Column, paragraph: Column):
        return lambda p: F.struct(
            F.when(p["u"].isNull(), "inserted").when(p["v"].isNull(), "removed").otherwise("changed").alias("change"),
            section.alias("section"), paragraph.alias("paragraph"), p["at"].alias("leaf"),
            F.coalesce(p["u"], p["v"]).alias("digest"))

    def paragraph(section: Column):
        return lambda p: walk(children(p["u"], ","), children(p["v"], ","), leaf(section, p["at"]))

    tree = lambda x: children(F.substring_index(x, ":", -1), r"\|")
    found = F.flatten(walk(tree(a), tree(b), lambda p: F.flatten(
        walk(children(p["u"], ";"), children(p["v"], ";"), paragraph(p["at"])))))
    return F.when(root(a) == root(b), F.slice(found, 1, 0)).otherwise(found)


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at most doc_id, looked up in two levels; a null is before all."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    heads = F.lit(cuts[::step])
    groups = F.lit([cuts[i:i + step] for i in range(0, len(cuts), step)])
    under = lambda array: F.size(F.filter(array, lambda c: c <= doc_id))
    coarse = under(heads)
    found = (coarse - 1) * step + under(F.element_at(groups, coarse))
    return F.when(coarse > 0, found).otherwise(0)


def with_next(docs: DataFrame, rows_per_range: int = 2_000, most_ranges: int = 20_000) -> DataFrame:
    """``docs`` (doc_id bigint, text, print) with next_text and next_print of the next row by doc_id.

    The last row's next is the first row. Rows lie in ranges of doc_id bounded by quantiles, so that no window holds
    them all; each range also gets the first row of the range after it. Null ids come first, equal ids go by text.
    Runs aggregates over the ids when called; the driver gets one id per range.
    """
    ranges = min(max(1, docs.count() // rows_per_range), most_ranges)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] if shares else None
    ranged = docs.withColumn("range", _range_of(F.col("doc_id"), sorted(set(cuts or []))))
    first = F.when(~F.max(F.col("doc_id").isNull()), F.min("doc_id"))  # a null comes before all
    heads = sorted(ranged.groupBy("range").agg(first).collect(), key=lambda r: r[0])
    # the first id of each range, and the range before it (the last range for the first one)
    before = {first: heads[i - 1][0] for i, (_, first) in enumerate(heads)}
    spark = docs.sparkSession
    ids, to = [i for i in before if i is not None] or [0], [r for i, r in before.items() if i is not None] or [0]
    guests = spark.range(1).select(F.explode(F.arrays_zip(
        F.lit(ids).cast("array<bigint>").alias("first_id"), F.lit(to).cast("array<int>").alias("to"))).alias("x"))
    guests = F.broadcast(guests.select("x.first_id", "x.to"))  # one row per range
    firsts = docs.join(guests, F.col("doc_id") == F.col("first_id")).select(
        "doc_id", "text", "print", F.col("to").alias("range"), F.lit(True).alias("guest"))
    if None in before:
        firsts = firsts.union(docs.where("doc_id is null").select(
            "doc_id", "text", "print", F.lit(before[None]), F.lit(True)))
    rows = ranged.select("doc_id", "text", "print", "range", F.lit(False).alias("guest")).union(firsts)
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    rows = rows.withColumn("next_print", F.lead("print").over(order))
    return rows.where(~F.col("guest")).drop("range", "guest")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last quarter of code points replaced by as many (or all) first ones of ``next_text``."""
    n = F.length(text)
    tail = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - tail), F.substring(next_text, F.lit(1), tail))
