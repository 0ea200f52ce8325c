"""Readers and writers, through files."""

import json

import pytest
from pyspark.sql import functions as F

from hirelens.operators.records import enrich
from hirelens.schema import COLUMNS, EXPORT_COLUMNS, SERVING, SOURCE_KEYS
from hirelens.sinks import files as out
from hirelens.sinks import serving, topic as topic_out
from hirelens.sources import files, lines, pages, topic

RAW = [
    {"岗位名称": "Java工程师（合肥）", "城市": "", "薪资": "15-25K", "job_id": 5, "职位描述": "a\nb", "careerJob": 3},
    {"岗位名称": "测试", "城市": "北京", "薪资": "面议", "job_id": "6"},
]


def posting(spark, **values):
    row = {**{c: "" for c in COLUMNS}, "career_job": None, **values}
    fields = ", ".join(f"{c} {'int' if c == 'career_job' else 'string'}" for c in COLUMNS)
    return spark.createDataFrame([tuple(row[c] for c in COLUMNS)], fields)


@pytest.fixture
def array_file(tmp_path):
    path = tmp_path / "raw.json"
    path.write_text(json.dumps(RAW, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(path)


def test_array_file(spark, array_file):
    rows = files.read_posting_array(spark, array_file).orderBy("job_id").collect()
    assert [(r.job_id, r.city, r.career_job, r.education) for r in rows] == [
        ("5", "", 3, None), ("6", "北京", None, None),
    ]


def test_array_file_keeps_input_order(spark, array_file):
    rows = files.read_posting_array_ordered(spark, array_file).orderBy("_file", "_pos").collect()
    assert [(r._pos, r.job_id) for r in rows] == [(0, "5"), (1, "6")]


def test_missing_and_broken_files_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_posting_array(spark, str(tmp_path / "none.json"))
    broken = tmp_path / "broken.json"
    broken.write_text('[{"job_id": "1"', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_posting_array(spark, str(broken)).collect()
    assert files.read_posting_array(spark, str(broken), tolerant=True).count() <= 1


LINES = ["[", '{"城市": "北京", "job_id": 5},', '{"城市": "a\\"b"}', "{bad", "", " ]"]


def test_lines_default(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    rows = lines.parse_lines(df).collect()
    assert [(r.city, r.job_id, r.corrupt_line) for r in rows] == [
        ("北京", "5", None), ('a"b', None, None), (None, None, "{bad"),
    ]


def test_lines_strict(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    jobs = enrich(lines.parse_lines(df, strict_compat=True))
    rows = jobs.select("city", "job_id", "effective_city", "negotiable").collect()
    assert [tuple(r) for r in rows] == [
        ("北京", "", "北京", True), ("a\\", "", "a\\", True), ("", "", "未知", True),
    ]


def test_only_one_trailing_comma_is_dropped(spark):
    df = spark.createDataFrame([("x,,",), ("y,\t",)], "value string")
    assert [r[0] for r in lines.record_lines(df).collect()] == ["x,", "y"]


def test_landed_directory_prunes_by_date(spark, tmp_path):
    for day in ("20260101", "20260102"):
        (tmp_path / f"dt={day}").mkdir()
        (tmp_path / f"dt={day}" / "jobs.json").write_text('{"job_id": "1"}\n', encoding="utf-8")
    df = files.read_landed(spark, str(tmp_path)).where("dt = '20260101'")
    assert [r.dt for r in df.collect()] == ["20260101"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and df.inputFiles()[0].count("dt=20260101") == 1


def test_json_round_trip(spark, tmp_path):
    df = posting(spark, job_id="7", job_name="岗", job_desc="a\nb")
    out.write_json(df, str(tmp_path / "j"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("*.json"))
    assert "岗位名称" in text and "岗" in text
    back = files.read_posting_lines(spark, str(tmp_path / "j")).first()
    assert (back.job_id, back.job_desc) == ("7", "a\nb")


def test_csv_export(spark, tmp_path):
    df = posting(spark, job_id="7", job_name='a,"b"', job_desc="x\ny", skill_tags="Java")
    out.export_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "c"))
    keys = {c: k for k, c in SOURCE_KEYS.items()}
    assert back.columns == [keys[c] for c in EXPORT_COLUMNS] and len(back.columns) == 18
    row = back.first()
    assert row["岗位名称"] == 'a,"b"' and row["职位描述"] == "x\ny"


def test_tsv_refuses_or_replaces(spark, tmp_path):
    df = spark.createDataFrame([("北京", 3)], "city string, n int")
    path = str(tmp_path / "t")
    out.write_tsv(df, path)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        out.write_tsv(df, path)
    out.write_tsv(df.withColumn("n", F.lit(4)), path, replace=True)
    assert spark.read.text(path).first()[0] == "北京\t4"


def test_messages(spark):
    df = posting(spark, job_id="", job_name="岗").unionByName(posting(spark, job_id="7", job_name="位"))
    sent = topic_out.posting_messages(df)
    assert sorted(str(r.key) for r in sent.collect()) == ["7", "None"]
    placed = sent.withColumns({"partition": F.lit(0), "offset": F.lit(1)})
    rows = topic.message_rows(placed).orderBy("job_id").collect()
    assert [(r.key, r.job_id, r.job_name) for r in rows] == [(None, "", "岗"), ("7", "7", "位")]
    detail = topic.message_detail(placed.withColumn("value", F.lit("{}"))).first()
    assert (detail.job_name, detail.salary) == ("N/A", "N/A")
    assert topic.take_messages(placed, 1).count() == 1


def test_topic_options():
    read = topic.topic_options("h:9092", "jobs", from_beginning=False)
    assert read["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in read
    assert topic.topic_options("h:9092", "jobs", max_per_batch=7)["maxOffsetsPerTrigger"] == "7"
    for refused in ({"max_per_batch": 7}, {"from_beginning": False}):
        with pytest.raises(ValueError):
            topic.topic_options("h:9092", "jobs", batch=True, **refused)
    batch = topic.topic_options("h:9092", "jobs", batch=True)
    assert (batch["startingOffsets"], batch["endingOffsets"]) == ("earliest", "latest")
    write = topic_out.publish_options("h:9092", "jobs")
    assert write["kafka.acks"] == "all" and write["kafka.compression.type"] == "gzip"


def test_anchors_as_a_browser_reads_them(spark):
    html = (
        '<a href="/jobs/detail/1" data-href="/jobs/detail/2">x</a><A HREF = \'/jobs/detail/3\'>y</A>'
        '<a data-href="/jobs/detail/4">z</a><a href="/jobs/detail/5?a=1&amp;b=2">w</a>'
    )
    df = spark.createDataFrame([(html,)], "html string")
    got = [r.href for r in pages.page_links(df, "https://h").collect()]
    assert got == ["/jobs/detail/1", "/jobs/detail/3", "/jobs/detail/5?a=1&b=2"]


def test_cut_off_array_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"job_id": "1"}]', encoding="utf-8")
    (tmp_path / "b.json").write_text('[{"job_id": "2"}, {"job', encoding="utf-8")
    with pytest.raises(Exception, match="no readable JSON array"):
        files.read_posting_array_ordered(spark, str(tmp_path)).collect()
    rows = files.read_posting_array_ordered(spark, str(tmp_path), tolerant=True).collect()
    assert sorted((r._file[-6:], r._error) for r in rows) == [("a.json", None), ("b.json", "no readable JSON array")]


AWKWARD = [
    {"job_id": str(i), "职位描述": text, "城市": "北京"} for i, text in enumerate([
        "plain", "a } b", '"}, {"job_id": "9"}', "\\\\", '\\"}', "[{", "]", "", "line\nbreak } \" {", "é日本\U0001F600}", "x" * 300])
]


@pytest.mark.parametrize("indent, ranges", [(None, 61), (2, 97), (1, 1 << 20)])
def test_array_files_in_byte_ranges(spark, tmp_path, indent, ranges):
    """Strings with braces, quotes and escapes, cut anywhere, come back in the order of the file."""
    for name, rows in {"a": AWKWARD, "b": AWKWARD[::-1] * 2, "c": [], "d": AWKWARD[:1]}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=name == "a", indent=indent), encoding="utf-8")
    (tmp_path / "e.json").write_text(' [\n\n ] \n', encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", ranges)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = files.read_posting_array_ordered(spark, str(tmp_path))
        got = {}
        for r in df.orderBy("_file", "_pos").collect():
            got.setdefault(r._file[-6], []).append((r._pos, r.job_id, r.job_desc))
        whole = lambda rows: [(i, r["job_id"], r["职位描述"]) for i, r in enumerate(rows)]
        assert got == {"a": whole(AWKWARD), "b": whole(AWKWARD[::-1] * 2), "d": whole(AWKWARD[:1])}
        if ranges == 61:
            assert spark.read.text(str(tmp_path / "b.json"), lineSep="}").rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_array_of_nested_objects(spark, tmp_path):
    rows = [{"job_id": {"a": [{"b": 1}, {"c": "}"}]}}, {"job_id": "2"}]
    (tmp_path / "n.json").write_text(json.dumps(rows), encoding="utf-8")
    got = files.read_posting_array_ordered(spark, str(tmp_path)).orderBy("_pos").collect()
    assert [json.loads(r.job_id) if r.job_id[0] == "{" else r.job_id for r in got] == [rows[0]["job_id"], "2"]


BROKEN = ['[{"a": 1}', '[{"a": 1},', '[{"a": 1} {"a": 2}]', '{"a": 1}', "", "[", "]", '[{"a": "1}]', '[{"a": 1}}]', '[{"a": 1}]]',
          '[{"a": 1}, x {"a": 2}]', '[{"a": 1}][{"a": 2}]', '[{"a": 1}, ]', "x", '[{"a": {"b": 1}]']


def test_broken_array_files(spark, tmp_path):
    """No file of these is taken for an array; a file without a byte holds nothing to read."""
    for i, text in enumerate(BROKEN):
        (tmp_path / f"{i:02}.json").write_text(text, encoding="utf-8")
    (tmp_path / "ok.json").write_text('[{"job_id": "1"}, {bad}]', encoding="utf-8")
    with pytest.raises(ValueError, match="no readable JSON array"):
        files.read_posting_array_ordered(spark, str(tmp_path))
    rows = files.read_posting_array_ordered(spark, str(tmp_path), tolerant=True).collect()
    assert sorted(r._file[-7:-5] for r in rows if r._error == "no readable JSON array") == [
        f"{i:02}" for i, text in enumerate(BROKEN) if text]
    assert sorted((r._pos, r.job_id, r._error) for r in rows if r._file.endswith("ok.json")) == [
        (0, "1", None), (1, None, "no readable record")]
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_posting_array_ordered(spark, str(tmp_path / "ok.json")).collect()


def test_upsert_keeps_keys_unique(spark, tmp_path):
    table = serving.SnapshotTable(spark, str(tmp_path / "t"))
    rows = lambda *x: spark.createDataFrame(x, "k string, n int")
    table.upsert(rows(("a", 1), ("a", 2), ("A", 3)), ["k"], order=["n"], collation=serving.MYSQL_LIKE)
    assert [(r.k, r.n) for r in table.current().collect()] == [("A", 3)]
    table.upsert(rows(("b", 1), ("b", 2)), ["k"])
    assert sorted((r.k, r.n) for r in table.current().collect()) == [("A", 3), ("b", 2)]
    with pytest.raises(Exception, match="null key k"):
        table.upsert(rows((None, 1)), ["k"])


def test_page_links(spark):
    html = '<a href="/jobs/detail/12?x">a</a><a href="/x">b</a><a class="k" href="https://h/jobs/detail/13">c</a>'
    df = spark.createDataFrame([(html,)], "html string")
    rows = pages.page_links(df, "https://jobs.example.com").collect()
    assert [(r.nth, r.link, r.job_id) for r in rows] == [
        (0, "https://jobs.example.com/jobs/detail/12?x", "12"), (1, "https://h/jobs/detail/13", "13"),
    ]


def test_serving_contracts(spark):
    assert len(SERVING) == 15
    rollup = spark.createDataFrame([("北京", 3, 1, 5, 2), ("上海", 9, 1, 5, 2)],
                                   "city string, avg_salary bigint, min_salary bigint, max_salary bigint, job_count bigint")
    df = serving.serving_table(rollup, "city_salary_stats")
    assert [r.city for r in df.collect()] == ["上海", "北京"]
    assert dict(df.dtypes)["avg_salary"] == "decimal(18,2)"


def test_upsert_touches_only_named_keys(spark):
    base = spark.createDataFrame([("a", 1, "t0"), ("b", 2, "t0")], "city string, job_count bigint, update_time string")
    delta = spark.createDataFrame([("b", 5), ("c", 7)], "city string, job_count bigint")
    got = serving.upsert(base, delta, ["city"], now=F.lit("t1"))
    assert sorted(map(tuple, got.collect())) == [("a", 1, "t0"), ("b", 5, "t1"), ("c", 7, "t1")]
    again = serving.upsert(got, delta, ["city"], now=F.lit("t1"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_upsert_with_a_collation_keeps_the_first_spelling(spark):
    base = spark.createDataFrame([("Java", 1, "t0")], "skill string, job_count bigint, update_time string")
    delta = spark.createDataFrame([("java", 5), ("JAVA ", 6), ("Go", 2)], "skill string, job_count bigint")
    got = serving.upsert(base, delta, ["skill"], F.lit("t1"), ["job_count"], serving.MYSQL_LIKE)
    assert sorted(map(tuple, got.collect())) == [("Go", 2, "t1"), ("Java", 6, "t1")]
    plain = serving.upsert(base, delta, ["skill"], F.lit("t1"))
    assert plain.count() == 4


def test_snapshot_table(spark, tmp_path):
    table = serving.SnapshotTable(spark, str(tmp_path / "s"))
    assert table.current() is None
    rows = lambda *r: spark.createDataFrame(list(r), "city string, job_count bigint")
    table.upsert(rows(("a", 1), ("b", 2)), ["city"], now=F.lit("t0"))
    table.upsert(rows(("b", 3)), ["city"], now=F.lit("t1"))
    assert sorted(map(tuple, table.current().collect())) == [("a", 1, "t0"), ("b", 3, "t1")]
    # an unfinished snapshot is not read
    (tmp_path / "s" / "v=9").mkdir()
    assert table.current().count() == 2
    table.replace(table.current().limit(0))
    assert table.current().count() == 0


class FakeConnection:
    """Writes what a task sends to files, one per commit."""

    def __init__(self, folder):
        self.folder, self.sent = folder, []

    def cursor(self):
        return self

    def executemany(self, statement, batch):
        self.sent += [[statement, *row] for row in batch]

    def commit(self):
        import uuid

        with open(f"{self.folder}/{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
            json.dump(self.sent, f)

    def close(self):
        pass


def test_database_upsert_sends_batches_from_tasks(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(5).selectExpr("cast(id as string) as city", "id as job_count").repartition(2)

    def connect():
        # pickled by value: the test module is not on the workers
        return FakeConnection(folder)

    import cloudpickle_compat

    cloudpickle_compat.by_value(__name__)
    serving.upsert_jdbc(df, connect, "city_job_count", ["city"])
    sent = [row for p in tmp_path.iterdir() for row in json.loads(p.read_text())]
    assert sorted(r[1:] for r in sent) == [[str(i), i] for i in range(5)]
    assert sent[0][0] == (
        "INSERT INTO city_job_count (city, job_count) VALUES (?, ?) ON DUPLICATE KEY UPDATE "
        "job_count = VALUES(job_count), update_time = CURRENT_TIMESTAMP"
    )
    assert serving.truncate_options("jdbc:x", "t")["truncate"] == "true"


def test_atomic_upsert_is_all_or_nothing(spark, tmp_path):
    """Over an embedded database file: a failing partition, or a failing merge, leaves the target untouched."""
    import sqlite3

    import cloudpickle_compat

    cloudpickle_compat.by_value(__name__)
    path = str(tmp_path / "t.db")

    def connect():
        return sqlite3.connect(path, timeout=60)

    db = connect()
    db.execute("CREATE TABLE t (city TEXT PRIMARY KEY, job_count INT CHECK (job_count < 1000), update_time TEXT)")
    db.execute("CREATE TABLE s (run_id TEXT, part INT, city TEXT, job_count INT)")
    db.execute("INSERT INTO t VALUES ('0', 7, 'then'), ('x', 8, 'then')")
    db.commit()
    read = lambda: sorted(connect().execute("SELECT city, job_count FROM t"))
    df = spark.range(40).select(F.col("id").cast("string").alias("city"), F.col("id").alias("job_count")).repartition(4)
    failing = df.withColumn("job_count", F.when(F.col("city") == "39", F.raise_error(F.lit("lost")).cast("long")).otherwise(1))
    for bad in (failing, df.withColumn("job_count", F.col("job_count") * 100)):
        with pytest.raises(Exception):
            serving.upsert_jdbc_atomic(bad, connect, "t", "s", ["city"], mysql=False)
        assert read() == [("0", 7), ("x", 8)]
    serving.upsert_jdbc_atomic(df, connect, "t", "s", ["city"], mysql=False, batch_size=3)
    assert read() == sorted([(str(i), i) for i in range(40)] + [("x", 8)])
    assert serving.merge_sql("t", "s", ["k"], ["n"]) == (
        "INSERT INTO t (k, n) SELECT k, n FROM s WHERE run_id = ? "
        "ON DUPLICATE KEY UPDATE n = VALUES(n), update_time = CURRENT_TIMESTAMP")


def test_stored_steps_are_removed_on_request(spark):
    from pathlib import Path

    from hirelens import session

    rows = session.stored(spark.range(5), "step")
    folder = Path(session._scratch_root(spark))
    assert rows.count() == 5 and list(folder.glob("step-*"))
    session.remove_scratch(spark)
    assert not folder.exists()
    assert session.stored(spark.range(3), "step").count() == 3


def test_plain_array_passes_no_exchange(spark, tmp_path):
    """Records without nested braces are cut where they are read; a file with others keeps all of its own."""
    from hirelens.sources import arrays

    (tmp_path / "a.json").write_text('[{"a": "x\\"y"}, {"a": "\\\\"},\n{"a": "2"}\n]\n', encoding="utf-8")
    records, broken = arrays.array_records(spark, str(tmp_path))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    (tmp_path / "b.json").write_text('[{"a": {"b": "}{"}}, {"a": "\\\\{"}, {"c": "{"}]', encoding="utf-8")
    (tmp_path / "c.json").write_text("[ ]", encoding="utf-8")
    records, broken = arrays.array_records(spark, str(tmp_path))
    assert sorted((r._file[-6:], r._pos, r.value) for r in records.collect()) == [
        ("a.json", 0, '{"a": "x\\"y"}'), ("a.json", 1, '{"a": "\\\\"}'), ("a.json", 2, '{"a": "2"}'),
        ("b.json", 0, '{"a": {"b": "}{"}}'), ("b.json", 1, '{"a": "\\\\{"}'), ("b.json", 2, '{"c": "{"}')]
    assert broken.count() == 0
