"""Publishing rows to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import text_of
from hirelens.schema import COLUMNS, to_source_keys


def message_of(df: DataFrame, key: str = "job_id") -> DataFrame:
    """(key, value) of every row: blank key -> null, value = JSON of the whole row."""
    row = to_source_keys(df)
    names = [F.col(f"`{c}`") for c in row.columns]
    key_name = dict(zip(df.columns, row.columns))[key]
    return row.select(
        F.nullif(text_of(f"`{key_name}`"), F.lit("")).alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
    )


def posting_messages(df: DataFrame) -> DataFrame:
    """Messages with the posting columns only."""
    return message_of(df.select(*[c for c in COLUMNS if c in df.columns]))


def publish_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options."""
    # fixed values: acknowledgement, compression and batching of the publisher
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.compression.type": "gzip",
        "kafka.retries": "5",
        "kafka.retry.backoff.ms": "100",
        "kafka.batch.size": "32768",
        "kafka.linger.ms": "5",
        "kafka.buffer.memory": "67108864",
        "kafka.max.request.size": "1048576",
        "kafka.max.in.flight.requests.per.connection": "5",
    }


def publish(df: DataFrame, servers: str, topic: str) -> None:
    posting_messages(df).write.format("kafka").options(**publish_options(servers, topic)).save()
