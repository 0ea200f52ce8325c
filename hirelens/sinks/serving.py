"""Serving tables: typed contracts, snapshot upsert and database upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.schema import SERVING

MYSQL_LIKE = "UNICODE_CI_AI_RTRIM"


def serving_table(rollup: DataFrame, name: str) -> DataFrame:
    """A rollup in the types and ranking order of its serving table."""
    return SERVING[name].ranked(SERVING[name].apply(rollup))


def upsert(
    base: DataFrame, delta: DataFrame, keys: list[str], now: Column | None = None,
    order: list[str] | None = None, collation: str | None = None,
) -> DataFrame:
    """Insert the rows of ``delta``; where the key exists, replace the measures (K8).

    ``update_time`` of every row in ``delta`` becomes ``now``, rows it does not name keep
    theirs, and an existing key keeps its spelling. Several delta rows for one key: the
    last in ``order`` wins, without it the one with the greatest measures, so the result
    has one row per key. A null key is an error. With a collation, keys that are equal under it are one key,
    as in a case-insensitive database.
    """
    now = F.current_timestamp() if now is None else now
    measures = [c for c in delta.columns if c not in keys and c != "update_time"]

    def match(name: str) -> str:
        return f"_key_{name}"

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {match(k): F.collate(k, collation) if collation else F.col(k) for k in keys}
        )

    named = [F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k}")).cast(delta.schema[k].dataType))
             .otherwise(F.col(k)).alias(k) for k in keys]
    new = keyed(delta.select(*named, *[c for c in delta.columns if c not in keys]))
    last = Window.partitionBy(*map(match, keys)).orderBy(
        *[F.desc(c) for c in (order or [*measures, *keys])])
    new = new.withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
    new = new.select(
        *map(match, keys), F.struct(*keys, *measures).alias("_new"), now.alias("_now")
    )
    old = keyed(base).select(*map(match, keys), F.struct(*base.columns).alias("_old"))
    both = old.join(new, [*map(match, keys)], "full_outer")
    hit = F.col("_new").isNotNull()

    def field(name: str) -> Column:
        if name == "update_time":
            return F.when(hit, F.col("_now")).otherwise(F.col("_old.update_time"))
        if name in measures:
            return F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}"))
        if name in keys:
            return F.coalesce(F.col(f"_old.{name}"), F.col(f"_new.{name}"))
        return F.col(f"_old.{name}")

    return both.select(*[field(c).alias(c) for c in base.columns])


class SnapshotTable:
    """A serving table kept as numbered Parquet snapshots under one directory.

    A plain install has no transactional table format, so every change writes a new
    snapshot and readers take the newest complete one (its ``_SUCCESS`` mark comes
    last). A failed or repeated write leaves the current snapshot untouched. One writer
    at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = [n for n in names if n.startswith("v=") and n[2:].isdigit()]
        done = [
            n for n in found
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS"))
        ]
        return sorted(int(n[2:]) for n in done)

    def current(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.parquet(f"{self.root}/v={versions[-1]}") if versions else None

    def replace(self, df: DataFrame) -> None:
        """Write a new current snapshot; an empty frame of the schema truncates."""
        versions = self._versions()
        df.write.mode("overwrite").parquet(f"{self.root}/v={versions[-1] + 1 if versions else 0}")

    def upsert(
        self, delta: DataFrame, keys: list[str], now: Column | None = None,
        ranked: Callable[[DataFrame], DataFrame] | None = None, **how,
    ) -> None:
        """Merge rows into the current snapshot; ``ranked`` puts the merged table in order before it is written."""
        base = self.current()
        stamped = delta.withColumn("update_time", F.current_timestamp() if now is None else now)
        merged = upsert(stamped.where("false") if base is None else base, delta, keys, now, **how)
        self.replace(ranked(merged) if ranked else merged)


def upsert_sql(table: str, keys: list[str], measures: list[str], mark: str = "?") -> str:
    """The keyed insert-or-update statement of a MySQL-like database (K8, K9)."""
    columns = keys + measures
    changes = [f"{m} = VALUES({m})" for m in measures] + ["update_time = CURRENT_TIMESTAMP"]
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))}) "
        f"ON DUPLICATE KEY UPDATE {', '.join(changes)}"
    )


def upsert_jdbc(
    df: DataFrame, connect: Callable[[], object], table: str, keys: list[str],
    mark: str = "?", batch_size: int = 1000,
) -> None:
    """Upsert from the tasks over DB-API connections, one transaction per partition (K9).

    Nothing passes through the driver. A retried task repeats the same upserts, which
    changes nothing.
    """
    measures = [c for c in df.columns if c not in keys]
    columns = keys + measures
    statement = upsert_sql(table, keys, measures, mark)

    def send(rows: Iterator) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            batch: list[tuple] = []
            for row in rows:
                batch.append(tuple(row[c] for c in columns))
                if len(batch) == batch_size:
                    cursor.executemany(statement, batch)
                    batch = []
            if batch:
                cursor.executemany(statement, batch)
            connection.commit()
        finally:
            connection.close()

    df.foreachPartition(send)


def merge_sql(table: str, staging: str, keys: list[str], measures: list[str], mysql: bool = True, mark: str = "?") -> str:
    """One statement that merges the staged rows of a run into a table, MySQL-like or with ``ON CONFLICT``."""
    columns = ", ".join(keys + measures)
    source = f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} WHERE run_id = {mark}"
    if mysql:
        changes = [f"{m} = VALUES({m})" for m in measures] + ["update_time = CURRENT_TIMESTAMP"]
        return f"{source} ON DUPLICATE KEY UPDATE {', '.join(changes)}"
    changes = [f"{m} = excluded.{m}" for m in measures] + ["update_time = CURRENT_TIMESTAMP"]
    return f"{source} ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {', '.join(changes)}"


def upsert_jdbc_atomic(
    df: DataFrame, connect: Callable[[], object], table: str, staging: str, keys: list[str],
    mysql: bool = True, mark: str = "?", batch_size: int = 1000,
) -> None:
    """Upsert in one transaction: all rows or none (K9).

    Tasks fill ``staging`` (the columns of ``df``, run_id and part) over connections of their own; when all have
    ended, one statement merges the rows of this run and the same transaction empties them from the staging table. A
    retried task first removes what its earlier attempt left; a failed run leaves the target as it was, and its staged
    rows are never merged, as they carry the name of that run.
    """
    run_id = uuid.uuid4().hex
    columns = df.columns
    insert = (f"INSERT INTO {staging} (run_id, part, {', '.join(columns)}) "
              f"VALUES ({', '.join([mark] * (len(columns) + 2))})")
    clear = f"DELETE FROM {staging} WHERE run_id = {mark}"

    def send(rows: Iterator) -> None:
        part = TaskContext.get().partitionId()
        connection = connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"{clear} AND part = {mark}", (run_id, part))
            while batch := [(run_id, part, *(row[c] for c in columns)) for row in islice(rows, batch_size)]:
                cursor.executemany(insert, batch)
            connection.commit()
        finally:
            connection.close()

    df.foreachPartition(send)
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(merge_sql(table, staging, keys, [c for c in columns if c not in keys], mysql, mark), (run_id,))
        cursor.execute(clear, (run_id,))
        connection.commit()
    finally:
        connection.close()


def truncate_options(url: str, table: str, **more: str) -> dict[str, str]:
    """JDBC writer options that empty a table and keep its definition (K10); mode overwrite."""
    return {"url": url, "dbtable": table, "truncate": "true", **more}
