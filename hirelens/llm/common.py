"""What the corpus operators share: reading, stored steps, match spans, text buffers for Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import scratch_dir, shuffle_files_removed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the folder all executors share and read it back (runs a job); its shuffle files go with the job."""
    path = scratch_dir(df.sparkSession, name)
    with shuffle_files_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs of start, end (code points) and value.

    The matches and the gaps between them come from the same pattern, so running lengths
    give the positions. ``pattern`` never matches the empty string. ``value`` is the group.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.split(text, pattern, -1)
    walk = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), matches.alias("hit"), values.alias("value")),
        F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("out")),
        lambda acc, x: F.when(x["hit"].isNull(), acc).otherwise(F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(x["gap"])).alias("start"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                x["value"].alias("value"),
            ))).alias("out"),
        )),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), walk).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


SPAN = "struct<start:int,end:int,value:string>"


def replace_spans(text: Column, spans: Column) -> Column:
    """Text with each span replaced by its ``with``; spans are sorted and do not overlap."""
    walk = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(
            x["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), x["with"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, walk).otherwise(text)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; a null is empty."""
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    _, at, data = array.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        array = batch.column(column)
        if not len(array):
            continue
        offsets, _ = text_bytes(array)
        start = 0
        while start < len(array):
            end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            end = min(max(end, start + 1), len(array))
            yield batch.slice(start, end - start)
            start = end


def long_column(values) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.int64), pa.int64())
