"""Streaming jobs: landing, deduplication, counts and the debug tap.

State and progress live in the checkpoint of each query, in a directory every
executor can reach, so a lost executor or a restart resumes where the last batch
ended.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from hirelens.functions.text import strip

EVERY_MINUTE = {"processingTime": "60 seconds"}
ONCE = {"availableNow": True}


def landing_rows(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """Message text with the processing date, in session time, as ``dt``."""
    now = F.current_timestamp() if clock is None else clock
    return messages.select("value", F.date_format(now, "yyyyMMdd").alias("dt"))


def land(
    messages: DataFrame, root: str, checkpoint: str, clock: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append message text under ``root/dt=YYYYMMDD/``, one set of files a minute."""
    return (
        landing_rows(messages, clock)
        .writeStream.format("text").partitionBy("dt")
        .option("path", root).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def land_rolled(
    messages: DataFrame, root: str, checkpoint: str, clock: Column | None = None,
    trigger: dict | None = None, roll_bytes: int = 128 << 20,
) -> StreamingQuery:
    """Land as :func:`land` does, in files of ``roll_bytes`` plus one message at most.

    ``messages`` has value, partition and offset. The running bytes of a topic partition decide the file of a message,
    so a batch that is replayed makes the same files again; the time of a batch is noted before its files, so they also
    get the same date. Files lie in ``root/dt=YYYYMMDD/roll=<batch>-<partition>-<nth>``.
    """
    now = F.current_timestamp() if clock is None else clock

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = f"{root}/_batches/batch={batch_id}"
        spark.range(1).select(F.date_format(now, "yyyyMMdd").alias("dt")).write.mode("ignore").json(note)
        day = spark.read.schema("dt string").json(note).first()["dt"]
        before = Window.partitionBy("partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
        bytes_before = F.coalesce(F.sum(F.octet_length("value") + 1).over(before), F.lit(0))
        nth = F.floor(bytes_before / roll_bytes).cast("string")
        rows = batch.select("value", F.lit(day).alias("dt"), F.concat_ws(
            "-", F.lit(str(batch_id)), F.col("partition").cast("string"), nth).alias("roll"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt", "roll").text(root))

    return (
        messages.select("value", "partition", "offset").writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()
    )


def _is_blank(key: str) -> Column:
    return strip(F.col(key).cast("string")) == ""


def first_seen(
    stream: DataFrame, key: str, event_time: str | None = None, within: str | None = None
) -> DataFrame:
    """Rows whose key was not seen before; blank keys pass and hold no state.

    Exact by default: every key is remembered, in the state store that the session names
    (``SETTINGS`` name the one on disk), and no row is lost however late it is. With
    ``within``, keys are forgotten that long after the watermark has passed them; rows
    later than that are dropped even if their key is new, and the query progress counts
    them (``numRowsDroppedByWatermark``). :func:`land_first_seen` keeps no state at all.
    """
    marked = stream.withWatermark(event_time, within) if within else stream
    keyed, blank = marked.where(~_is_blank(key)), marked.where(_is_blank(key))
    once = keyed.dropDuplicatesWithinWatermark([key]) if within else keyed.dropDuplicates([key])
    return once.unionByName(blank)


def land_first_seen(
    stream: DataFrame, key: str, root: str, checkpoint: str, trigger: dict | None = None, buckets: int = 64,
) -> StreamingQuery:
    """Rows whose key was not seen before, with the keys in a table instead of the state store.

    Every batch is joined with the keys of earlier batches, which lie by bucket of their hash under ``root/ids``, and
    writes its rows to ``root/rows/batch=N`` and its new keys to ``root/ids/batch=N``. A batch that is replayed leaves
    out its own keys and replaces its own directories, so it adds nothing. Memory does not grow with the keys, and no
    key is ever forgotten; blank keys pass.
    """
    ids, kind = f"{root}/ids", stream.schema[key].dataType.simpleString()

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        fresh = batch.where(~_is_blank(key)).dropDuplicates([key]).withColumn("_bucket", bucket)
        if batch_id > 0:
            seen = spark.read.schema(f"`{key}` {kind}, batch bigint, _bucket int").option("basePath", ids).parquet(f"{ids}/*")
            seen = seen.where(F.col("batch") < batch_id).select(key, "_bucket")
            fresh = fresh.join(seen, [key, "_bucket"], "left_anti")
        rows = fresh.unionByName(batch.where(_is_blank(key)).withColumn("_bucket", F.lit(-1)))
        target = f"{root}/rows/batch={batch_id}"
        rows.write.mode("overwrite").parquet(target)
        written = spark.read.schema(rows.schema).parquet(target).where("_bucket >= 0")
        written.select(key, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{ids}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()
    )


def first_seen_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """What :func:`land_first_seen` has let through so far."""
    return spark.read.schema(schema).parquet(f"{root}/rows/batch=*")


def partition_counts(messages: DataFrame, partition: str = "partition") -> DataFrame:
    """Messages per topic partition (A18); a running count on a stream."""
    return messages.groupBy(partition).agg(F.count(F.lit(1)).alias("message_count"))


def write_state(counts: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep a running aggregate as the newest ``root/batch=N`` directory.

    A replayed batch overwrites its own directory, so the result is the same.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()
    )


def rates(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of the recent batches (A18); :class:`ProgressTable` keeps all."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]


PROGRESS = "query string, run string, batch bigint, rows bigint, milliseconds bigint"


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of every batch of the queries of a session, one small file each, under ``root``.

    A query itself remembers its last hundred batches only. ``with ProgressTable(spark, root):`` listens; ``wait``
    returns when the end of a query has arrived, as progress comes after the batch.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, p.batchDuration)
        path = f"{self.root}/run={p.runId}/batch={p.batchId}"  # a batch that had nothing to do is told again
        if p.numInputRows:
            self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").json(path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        return self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds)

    def batches(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(f"{self.root}/run=*/batch=*")

    def totals(self) -> DataFrame:
        """Batches, rows and mean rows per second of every query, over its whole runs."""
        return self.batches().groupBy("query").agg(
            F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"),
            (F.sum("rows") * 1000 / F.nullif(F.sum("milliseconds"), F.lit(0))).alias("rows_per_second"))


def debug_tap(
    messages: DataFrame, root: str, checkpoint: str, log=print, shown: int = 10,
    max_chars: int = 200, trigger: dict | None = None,
) -> StreamingQuery:
    """Every message to a file, and the first few of a batch to a log.

    Both taps see every batch. Only the ``shown`` log lines, cut to ``max_chars``, come
    to the driver; the files get whole messages.
    """

    def tap(batch: DataFrame, batch_id: int) -> None:
        batch.select("value").write.mode("overwrite").text(f"{root}/batch={batch_id}")
        for row in batch.select(F.substring("value", 1, max_chars).alias("value")).take(shown):
            log(row["value"])

    return (
        messages.writeStream.foreachBatch(tap)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_MINUTE)).start()
    )
