"""JSON array files of any size, read in byte ranges.

A file is read as text that is cut after every closing brace, so the file system may split it anywhere. Whether a brace
closes a record depends on all that comes before it: on the quotes (is it inside a string?) and on the braces that are
open. Both are running sums. They are taken inside each byte range first; one small row per range then goes through a
window over the file and tells every range the state it starts in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.session import stored

BEFORE_FIRST, BEFORE_NEXT = r"^\s*\[\s*\z", r"^\s*,\s*\z"
END_ARRAY, EMPTY_ARRAY = r"^\s*\]\s*$", r"^\s*\[\s*\]\s*$"
OPEN, NEXT, END, EMPTY = 1, 2, 3, 4
_RANGE = ["_file", "_block"]


def _inside(value: Column) -> Column:
    """Sum over the fragments before, in the same byte range."""
    window = Window.partitionBy(*_RANGE).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _ranges(value: Column) -> Column:
    """Sum over the byte ranges before, in the same file."""
    window = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _count(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _opened(text: Column, in_string: bool) -> Column:
    """Braces that a fragment opens outside of strings; ``in_string`` says how it starts."""
    text = F.concat(F.lit('"'), text) if in_string else text
    return _count(F.regexp_replace(text, '"[^"]*("|$)', ""), "{")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, in order of (_file, _block, _at), with what it does to quotes and braces.

    ``_at`` counts on by one inside a byte range.
    """
    rows = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), "value")
    # an escaped character is no quote; a closing brace is never escaped, so none is cut in two
    value, escape = F.col("value"), F.lit("\\")
    short = F.replace(F.replace(value, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    plain = F.when(~F.contains(value, escape), value).when(
        F.contains(value, F.lit("\\{")), F.regexp_replace(value, r"\\.", "")).otherwise(short)
    rows = rows.withColumns({"_plain": plain, "_head": F.substring_index("value", "{", 1)})
    rows = rows.withColumns({
        "_quotes": _count(F.col("_plain"), '"'), "_all": _count(F.col("_plain"), "{"),
        "_odd": F.pmod(_count(F.substring_index("_plain", "{", 1), '"'), F.lit(2))})
    # one brace is inside a string if an odd number of quotes is before it
    few = F.when(F.col("_all") == 0, 0)
    kind = (F.when(F.contains(value, F.lit("{")), F.when(F.col("_head").rlike(BEFORE_FIRST), OPEN).when(
        F.col("_head").rlike(BEFORE_NEXT), NEXT)).when(value.rlike(END_ARRAY), END).when(value.rlike(EMPTY_ARRAY), EMPTY))
    return rows.select(
        *_RANGE, "_at", "value", "_quotes", kind.alias("_kind"),
        few.when(F.col("_all") == 1, 1 - F.col("_odd")).otherwise(_opened(F.col("_plain"), False)).alias("_opened"),
        few.when(F.col("_all") == 1, F.col("_odd")).otherwise(_opened(F.col("_plain"), True)).alias("_opened_in_string"))


def _braces(rows: DataFrame, in_string: Column) -> DataFrame:
    """Braces that each fragment opens and closes, when ``in_string`` says whether its range starts inside a string."""
    inside = (F.pmod(_inside(F.col("_quotes")), F.lit(2)) == 1) != in_string
    rows = rows.withColumn("_strung", inside)
    return rows.withColumns({
        "_opens": F.when(F.col("_strung"), F.col("_opened_in_string")).otherwise(F.col("_opened")),
        "_closes": (F.col("_strung") == (F.pmod(F.col("_quotes"), F.lit(2)) == 1)).cast("int")}).drop("_strung")


def _placed(rows: DataFrame) -> DataFrame:
    """Fragments joined with ``range_starts``: the depth before them, whether they start and whether they end a record."""
    rows = _braces(rows, F.col("_in_string"))
    depth = F.col("_start_depth") + _inside(F.col("_opens") - F.col("_closes"))
    rows = rows.withColumn("_depth", depth)
    ends = (F.col("_closes") == 1) & (F.col("_depth") + F.col("_opens") == 1)
    return rows.withColumns({"_starts": (F.col("_depth") == 0) & (F.col("_opens") > 0), "_ends": ends})


def _instead(ranges: DataFrame, others: DataFrame, *names: str) -> DataFrame:
    """``ranges`` with the columns ``names`` of ``others`` where that has the range."""
    others = others.select(*_RANGE, *[F.col(c).alias(f"_new{c}") for c in names])
    both = ranges.join(others, _RANGE, "left")
    return both.withColumns({c: F.coalesce(f"_new{c}", c) for c in names}).drop(*[f"_new{c}" for c in names])


def range_starts(facts: DataFrame) -> DataFrame:
    """Per byte range: in_string and depth where it starts, records that end before it, and whether its file is whole.

    In a plain range every fragment is a record, but for the rest after the last one; ``_from`` is its first place. Only
    ranges of other shapes are gone through in order, by their counts and marks; no text passes through an exchange.
    """
    odd = F.pmod("_quotes", F.lit(2)) == 1
    record = F.col("_opened") == 1
    led = F.coalesce(F.col("_kind") == OPEN, F.lit(False))
    stray = ~F.coalesce(F.col("_kind").isin(OPEN, NEXT), F.lit(False))
    ranges = stored(facts.groupBy(*_RANGE).agg(
        F.sum("_quotes").alias("_quotes"), F.count_if(odd).alias("_odd"), F.min("_at").alias("_from"),
        F.sum(F.col("_opened") - 1).alias("_plain"), F.sum("_opened_in_string").alias("_string"),
        F.min_by("_kind", "_at").alias("_first"), F.max_by("_kind", "_at").alias("_last"),
        F.count_if(~record).alias("_others"), F.max_by("_opened", "_at").alias("_last_opened"),
        F.count_if(record).alias("_n"), F.count_if(record & led).alias("_led"),
        F.count_if(record & stray).alias("_stray")), "ranges")
    cut = ranges.where("_odd > 0").select(*_RANGE)
    if not cut.isEmpty():  # strings that go over a brace: which braces count depends on the fragments before
        change = F.sum(F.col("_opens") - F.col("_closes"))
        for name, in_string in (("_plain", False), ("_string", True)):
            changes = _braces(facts.join(cut, _RANGE), F.lit(in_string)).groupBy(*_RANGE).agg(change.alias(name))
            ranges = _instead(ranges, changes, name)
    inside = F.pmod(_ranges(F.col("_quotes")), F.lit(2)) == 1
    ranges = ranges.withColumn("_in_string", inside)
    ranges = ranges.withColumn("_change", F.when(F.col("_in_string"), F.col("_string")).otherwise(F.col("_plain")))
    ranges = ranges.withColumn("_start_depth", _ranges(F.col("_change")))
    shape = (F.col("_others") == 0) | ((F.col("_others") == 1) & (F.col("_last_opened") == 0))
    plain = ~F.col("_in_string") & (F.col("_start_depth") == 0) & (F.col("_odd") == 0) & shape
    ranges = stored(ranges.withColumn("_is_plain", plain), "ranges")

    other = ranges.where("not _is_plain").select(*_RANGE, "_in_string", "_start_depth")
    if not other.isEmpty():
        placed = _placed(facts.join(other, _RANGE)).groupBy(*_RANGE).agg(
            F.count_if("_ends").alias("_n"), F.count_if(F.col("_starts") & led).alias("_led"),
            F.count_if(F.col("_starts") & stray).alias("_stray"))
        ranges = _instead(ranges, placed, "_n", "_led", "_stray")
    # the text after the last brace counts as if a brace followed it, hence a depth of -1 at the end
    file = Window.partitionBy("_file")
    total = lambda c: F.sum(c).over(file)
    closed = (total("_change") == -1) & (F.pmod(total("_quotes"), F.lit(2)) == 0) & (total("_stray") == 0)
    first, last = F.min_by("_first", "_block").over(file), F.max_by("_last", "_block").over(file)
    array = (first == OPEN) & (last == END) & (total("_led") == 1)
    sound = F.coalesce(closed & (array | (first == EMPTY)), F.lit(False))
    ranges = ranges.withColumns({"_sound": sound, "_records": _ranges(F.col("_n"))})
    return stored(ranges.select(
        *_RANGE, "_in_string", "_start_depth", "_records", "_sound", "_is_plain", "_from"), "ranges")


def array_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The objects of JSON array files as text, and the files that hold no readable array.

    Records: _file, _pos (place in the file, from 0) and value. A file is as many tasks as it has byte ranges. Its
    fragments are worked out once and stored. Texts of plain ranges pass through no exchange, others through one, keyed by byte
    range, and records with braces in strings or objects in objects through another. Files: _file, where an array is cut
    off, not closed or not separated by commas; their records are left out. Files without a byte are not listed. Runs
    jobs when called.
    """
    rows = stored(fragments(spark, path), "fragments")
    starts = range_starts(rows.drop("value"))
    broken = starts.where(~F.col("_sound")).select("_file").distinct()
    text = F.concat("value", F.lit("}"))
    sound = starts.where("_sound")
    records = rows.where("_opened = 1").join(sound.where("_is_plain"), _RANGE).select(
        "_file", (F.col("_records") + F.col("_at") - F.col("_from")).alias("_pos"), text.alias("value"))
    other = sound.where("not _is_plain")
    if not other.isEmpty():
        parts = _placed(rows.join(other, _RANGE))
        parts = parts.withColumn("_pos", F.col("_records") + _inside(F.col("_ends").cast("bigint")))
        parts = parts.where((F.col("_depth") > 0) | F.col("_starts"))
        alone = F.col("_starts") & F.col("_ends")
        single = parts.where(alone).select("_file", "_pos", text.alias("value"))
        pieces = F.array_sort(F.collect_list(F.struct("_block", "_at", text.alias("text"))))
        joined = parts.where(~alone).groupBy("_file", "_pos").agg(
            F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("value"))
        records = records.unionByName(single).unionByName(joined)
    # only an opening bracket or a comma is before the first brace of a record
    return records.withColumn("value", F.substr("value", F.instr("value", "{"))), broken
