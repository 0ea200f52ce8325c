"""Text lines -> postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.functions.text import once, trim_controls
from hirelens.schema import SOURCE_KEYS, SOURCE_POSTING, from_source_keys


def record_lines(lines: DataFrame, value: str = "value", keep_all: bool = False) -> DataFrame:
    """Drop blank lines and array brackets, and one trailing comma of the rest (S3).

    With ``keep_all`` nothing is dropped; ``is_record`` tells the lines apart.
    """
    trimmed = lines.withColumn(value, once(trim_controls(value)))
    is_record = F.coalesce(~F.col(value).isin("", "[", "]"), F.lit(False))
    trimmed = trimmed.withColumn("is_record", is_record) if keep_all else trimmed.where(is_record)
    ends = F.right(F.col(value), F.lit(2)).contains(",")  # the pattern reads the whole line, so few lines get to it
    return trimmed.withColumn(value, F.when(ends, F.regexp_replace(value, ",$", "")).otherwise(F.col(value)))


def text_field(line: Column, key: str) -> Column:
    """First ``"key": "text"`` of a line, without unescaping; blank when there is none.

    Numbers, nulls and nested values are not text, and a quote inside a value ends it.
    """
    return F.regexp_extract(line, f'"{key}"\\s*:\\s*"([^"]*)"', 1)


def valid_records(rows: DataFrame) -> DataFrame:
    """Parsed lines or messages without the broken ones, which are no postings."""
    return rows.where(F.col("corrupt_line").isNull())


def parse_lines(
    lines: DataFrame, value: str = "value", strict_compat: bool = False, keep_all: bool = False
) -> DataFrame:
    """Posting columns of every record line, other columns kept (S3 + S4 + F28).

    Default: a JSON parse; a line that is no JSON object has its text in
    ``corrupt_line`` and null fields. ``strict_compat``: the pattern scan of
    :func:`text_field`, which never fails - a broken line is a record of blanks.
    Rollups over the default take :func:`valid_records`. ``keep_all`` keeps lines that
    are no records, too, as rows of nulls with ``is_record`` false.
    """
    records = record_lines(lines, value, keep_all)
    others = [c for c in records.columns if c != value]
    if keep_all:
        records = records.withColumn(value, F.when(F.col("is_record"), F.col(value)))
    if strict_compat:
        fields = [
            text_field(F.col(value), key).alias(name)
            if name != "career_job"
            else F.lit(None).cast("int").alias(name)
            for key, name in SOURCE_KEYS.items()
        ]
        return records.select(*others, *fields, F.lit(None).cast("string").alias("corrupt_line"))
    schema = T.StructType([*SOURCE_POSTING.fields, T.StructField("corrupt_line", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_line"}
    row = F.from_json(value, schema, options)
    return from_source_keys(records.select(*others, once(row).alias("_row")).select(*others, "_row.*"))
