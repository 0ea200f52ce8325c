"""Topic sources. The connector is not part of a plain Spark install, so option sets
are plain functions and readers fail with Spark's own message when it is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.schema import SOURCE_POSTING, from_source_keys


def topic_options(
    servers: str, topic: str, from_beginning: bool = True, max_per_batch: int | None = None,
    group_id: str | None = None, batch: bool = False,
) -> dict[str, str]:
    """Reader options (S6, S7): earliest or latest, and how much a batch takes.

    Progress lives in the query checkpoint; there is no auto-commit to configure. A batch
    takes all there is unless ``max_per_batch`` says otherwise. A batch read is bounded by
    both ends of the topic, so it takes neither option.
    """
    if batch and (max_per_batch or not from_beginning):
        raise ValueError("a batch read goes from the earliest to the latest message")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_beginning or batch else "latest",
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if batch:
        options["endingOffsets"] = "latest"
    elif max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Messages as (key, value, topic, partition, offset) with text key and value."""
    reader = spark.readStream if stream else spark.read
    return text_messages(reader.format("kafka").options(**options).load())


def text_messages(messages: DataFrame) -> DataFrame:
    """Binary key and value as UTF-8 text, with topic, partition and offset."""
    return messages.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        *[c for c in ("topic", "partition", "offset") if c in messages.columns],
    )


def message_rows(messages: DataFrame) -> DataFrame:
    """Posting columns of JSON messages next to their position.

    A message that is no JSON object has its text in ``corrupt_line`` and null fields.
    """
    where = [c for c in ("key", "topic", "partition", "offset") if c in messages.columns]
    schema = T.StructType([*SOURCE_POSTING.fields, T.StructField("corrupt_line", T.StringType())])
    row = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_line"})
    return from_source_keys(messages.select(*where, row.alias("_row")).select(*where, "_row.*"))


def message_detail(messages: DataFrame) -> DataFrame:
    """Partition, offset, title, company and pay; what is missing reads N/A."""
    rows = message_rows(messages)
    return rows.select(
        "partition", "offset",
        *[F.coalesce(F.col(c), F.lit("N/A")).alias(c) for c in ("job_name", "company_name", "salary")],
    )


def take_messages(messages: DataFrame, n: int) -> DataFrame:
    """Stop after n messages (O4); a batch read."""
    return messages.limit(n)
