"""Posting files: JSON arrays, JSON lines and dated landing directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.schema import SOURCE_POSTING, from_source_keys
from hirelens.sources.arrays import array_records
from hirelens.sources.lines import parse_lines


def read_posting_array(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Files that are one JSON array each.

    A missing path or, unless ``tolerant``, a malformed file is an error. One array
    file is one task here; :func:`read_posting_array_ordered` reads it in parts.
    """
    mode = "PERMISSIVE" if tolerant else "FAILFAST"
    reader = spark.read.schema(SOURCE_POSTING).option("multiLine", True).option("mode", mode)
    return from_source_keys(reader.json(path))


def read_posting_array_ordered(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """The same for files of any size, with ``_file`` and ``_pos`` as the input order that first-wins needs.

    A file is read in byte ranges, as many tasks as it has (:mod:`hirelens.sources.arrays`). A file without a readable
    array is an error when called, a record that is no JSON object when read. With ``tolerant`` such a file is one row without fields and
    place, and such a record one without fields; ``_error`` says why, and is null for all others.
    """
    records, broken = array_records(spark, path)
    reason = "no readable JSON array"
    corrupt = "_corrupt"
    if not tolerant:
        first = broken.first()
        if first:
            raise ValueError(f"{reason}: {first['_file']}")
        row = F.from_json("value", SOURCE_POSTING, {"mode": "FAILFAST"})
        return from_source_keys(records.select(row.alias("_row"), "_file", "_pos").select("_row.*", "_file", "_pos"))
    told = T.StructType([*SOURCE_POSTING.fields, T.StructField(corrupt, T.StringType())])
    row = F.from_json("value", told, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = records.select(row.alias("_row"), "_file", "_pos").select("_row.*", "_file", "_pos")
    error = F.when(F.col(corrupt).isNotNull(), F.lit("no readable record"))
    rows = from_source_keys(rows.withColumn("_error", error).drop(corrupt))
    return rows.unionByName(broken.withColumn("_error", F.lit(reason)), allowMissingColumns=True)


def read_posting_lines(spark: SparkSession, path: str, strict_compat: bool = False) -> DataFrame:
    """Text files with one posting per line (S3 + S4)."""
    return parse_lines(spark.read.text(path), strict_compat=strict_compat)


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """The landing root as (value, dt). ``dt`` is declared: inferred, it would be a number.

    A filter on ``dt`` prunes directories, so one day reads one day's files.
    """
    schema = T.StructType().add("value", "string").add("dt", "string")
    return spark.read.schema(schema).format("text").load(root).select("value", "dt")
