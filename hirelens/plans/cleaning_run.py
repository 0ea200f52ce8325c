"""The cleaning run as one job: rows, high-value rows and report from one reading."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hirelens.functions.repair import content_key
from hirelens.operators.cleaning import (
    ALWAYS_TOLD, PROVENANCE, first_rows, high_value_test, repair_counters, repair_fields,
)
from hirelens.schema import SOURCE_KEYS, from_source_keys, to_source_keys
from hirelens.sinks.files import write_report

# Rows of one file. A compressed file is read by one task.
FILE_ROWS = 500_000
ALL, HIGH = "cleaned", "high_value"
CONTENT = ["company_name", "job_name", "city"]


def run_cleaning(raw: DataFrame, order: list[str], root: str) -> DataFrame:
    """Clean postings into ``root/rows/output=cleaned`` and ``root/rows/output=high_value`` (K1, K2) and report.

    The rows are read once and written by one job: a high-value row is sent to both outputs, and the counters of the
    report are observed while the rows pass. Rows are JSON lines in gzip files, since most of their bytes are repeated
    keys. Only the number of repeated contents needs them side by side; it is counted over three columns of what was
    written. Returns the report, (metric, value) rows, which is also written to ``root/report``. An output that is
    there is replaced.
    """
    spark = raw.sparkSession
    kept = repair_fields(first_rows(raw, order))
    seen = Observation(f"cleaning-{uuid.uuid4().hex}")
    kept = kept.observe(seen, *[count.alias(name) for name, count in repair_counters().items()])
    both = F.when(high_value_test(), F.array(F.lit(ALL), F.lit(HIGH))).otherwise(F.array(F.lit(ALL)))
    rows = kept.drop("content_key", "_rows", *PROVENANCE).withColumn("output", F.explode(both))
    packed = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS}
    to_source_keys(rows).write.mode("overwrite").options(**packed).partitionBy("output").json(f"{root}/rows")

    counted = dict(seen.get)
    schema = ", ".join(f"`{key}` string" for key, name in SOURCE_KEYS.items() if name in CONTENT)
    written = from_source_keys(spark.read.schema(f"{schema}, output string").json(f"{root}/rows"))
    contents = written.where(F.col("output") == ALL).agg(F.count_distinct(content_key(*CONTENT)).alias("n"))
    counted["duplicate_content_warning"] = counted["output_count"] - contents.first()["n"]
    told = [(name, value) for name, value in counted.items() if value or name in ALWAYS_TOLD]
    write_report(spark.createDataFrame(told, "metric string, value bigint"), f"{root}/report")
    return spark.read.schema("metric string, value bigint").json(f"{root}/report")
