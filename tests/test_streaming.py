"""Streams over files, run to the end, against the batch result."""

import json

import pytest
from pyspark.sql import functions as F

from hirelens.streaming import jobs as S

SCHEMA = "key string, value string, partition int, offset bigint"


@pytest.fixture
def source(spark, tmp_path):
    """Three files of messages; read one file per batch."""
    root = tmp_path / "in"
    root.mkdir()
    n = 0
    for i in range(3):
        with open(root / f"f{i}.json", "w", encoding="utf-8") as f:
            for _ in range(10):
                row = {"key": str(n), "value": json.dumps({"job_id": str(n)}), "partition": n % 3, "offset": n}
                f.write(json.dumps(row) + "\n")
                n += 1
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(root))


def test_landing(spark, source, tmp_path):
    args = (source, str(tmp_path / "out"), str(tmp_path / "state"))
    clock = F.lit("2026-01-02 23:59:59").cast("timestamp")
    for _ in range(2):  # a restart lands nothing twice
        S.land(*args, clock=clock, trigger=S.ONCE).awaitTermination()
    from hirelens.sources.files import read_landed

    landed = read_landed(spark, str(tmp_path / "out"))
    assert {(r.value, r.dt) for r in landed.collect()} == {
        (json.dumps({"job_id": str(i)}), "20260102") for i in range(30)
    }
    assert landed.count() == 30


def test_landing_date_is_session_time(spark):
    df = spark.createDataFrame([("x",)], "value string")
    at = F.lit("2026-01-02 23:30:00+00:00").cast("timestamp")
    assert S.landing_rows(df, at).first().dt == "20260102"


def test_counts_equal_batch(spark, source, tmp_path):
    query = S.write_state(S.partition_counts(source), str(tmp_path / "o"), str(tmp_path / "s"), S.ONCE)
    query.awaitTermination()
    last = max(p["batchId"] for p in query.recentProgress)
    got = spark.read.parquet(f"{tmp_path}/o/batch={last}").orderBy("partition").collect()
    assert [tuple(r) for r in got] == [(0, 10), (1, 10), (2, 10)]
    assert sum(r["rows"] for r in S.rates(query)) == 30


def test_debug_tap_fans_out(spark, source, tmp_path):
    seen = []
    S.debug_tap(source, str(tmp_path / "o"), str(tmp_path / "s"), seen.append, 2, 5, S.ONCE).awaitTermination()
    assert spark.read.text(f"{tmp_path}/o/batch=*").count() == 30
    assert len(seen) == 6 and all(len(x) == 5 for x in seen)


def test_dedup_across_batches(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    days = {10: ("1", "2"), 20: ("1", "", ""), 21: ("3", "2"), 1: ("late", "3")}
    for n, (day, ids) in enumerate(days.items()):  # the last file is older than the others
        with open(root / f"f{n}.json", "w", encoding="utf-8") as f:
            for job in ids:
                f.write(json.dumps({"job_id": job, "ts": f"2026-01-{day:02} 00:00:00"}) + "\n")
    stream = (
        spark.readStream.schema("job_id string, ts timestamp").option("maxFilesPerTrigger", 1).json(str(root))
    )
    (
        S.first_seen(stream, "job_id").writeStream.format("parquet")
        .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "s"))
        .trigger(**S.ONCE).start().awaitTermination()
    )
    got = sorted(r.job_id for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == ["", "", "1", "2", "3", "late"]


def test_table_dedup_over_late_repeats_and_restarts(spark, tmp_path):
    """A late repeat and a late new id are both right; a batch that ran without being noted adds nothing again."""
    root = tmp_path / "in"
    root.mkdir()
    for n, ids in enumerate([("1", "2", " "), ("1", "", None), ("3", "2", "3"), ("late", "1")]):
        with open(root / f"f{n}.json", "w", encoding="utf-8") as f:
            f.write("".join(json.dumps({"job_id": i}) + "\n" for i in ids))
        stream = spark.readStream.schema("job_id string").option("maxFilesPerTrigger", 1).json(str(root))
        args = (stream, "job_id", str(tmp_path / "o"), str(tmp_path / "s"), S.ONCE)
        query = S.land_first_seen(*args)
        query.awaitTermination()
        assert query.exception() is None and not any(p["stateOperators"] for p in query.recentProgress)
    (tmp_path / "s" / "commits" / "3").unlink()  # as if the session had ended before the batch was noted
    (tmp_path / "s" / "commits" / ".3.crc").unlink(missing_ok=True)
    S.land_first_seen(*args).awaitTermination()
    got = S.first_seen_rows(spark, str(tmp_path / "o"), stream.schema).collect()
    assert sorted(str(r.job_id) for r in got) == sorted([" ", "", "1", "2", "3", "None", "late"])


def test_landed_files_roll_by_size(spark, source, tmp_path):
    """No file is over the limit plus a message, none is cut by count, all messages are there once."""
    args = (source, str(tmp_path / "out"), str(tmp_path / "state"))
    for day in ("2026-01-02", "2026-01-03"):  # the replay of a batch keeps its date
        clock = F.lit(f"{day} 23:59:59").cast("timestamp")
        S.land_rolled(*args, clock=clock, trigger=S.ONCE, roll_bytes=40).awaitTermination()
        for name in ("2", ".2.crc"):
            (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    from hirelens.sources.files import read_landed

    landed = read_landed(spark, str(tmp_path / "out"))
    assert sorted((r.value, r.dt) for r in landed.collect()) == sorted(
        (json.dumps({"job_id": str(i)}), "20260102") for i in range(30))
    files = list((tmp_path / "out").rglob("*.txt"))
    longest = max(len(json.dumps({"job_id": str(i)})) + 1 for i in range(30))
    assert all(f.stat().st_size <= 40 + longest for f in files) and any(f.stat().st_size > 40 for f in files)


def test_totals_of_more_than_a_hundred_batches(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for n in range(104):
        (root / f"f{n:03}.json").write_text(f'{{"n": {n}}}\n' * (1 + n % 3), encoding="utf-8")
    stream = spark.readStream.schema("n int").option("maxFilesPerTrigger", 1).json(str(root))
    with S.ProgressTable(spark, str(tmp_path / "progress")) as table:
        query = (stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "s"))
                 .trigger(**S.ONCE).start())
        query.awaitTermination()
        assert table.wait(query)
        total = table.totals().first()
    assert (total["batches"], total["rows"]) == (104, sum(1 + n % 3 for n in range(104)))
    assert len(query.recentProgress) <= 100 and total["rows_per_second"] > 0
