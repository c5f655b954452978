import json

import pytest

from tachoflow.operators.silver import enrich, silver_sql
from tachoflow.operators.staging import latest_wins
from tachoflow.plans.lake import VERSION_MARK, Lake
from tachoflow.sources.sensors import sensor_payload, sensor_rows
from tachoflow.streaming.dedup import LOG, current_rows, log_of, merge_batch
from tachoflow.streaming.live import LIVE_TABLES, SIZED_CACHE, add_messages, live_table, live_tables

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n INT")


def _read(df):
    return sorted(r.n for r in df.collect())


def test_tables_change_together(spark, tmp_path):
    lake = Lake(spark, root=str(tmp_path / "lake"))
    for turn in (1, 2):
        written = lake.write("gold", "a", _numbers(spark, turn))
        assert _read(written) == [turn]
        if turn == 2:
            assert _read(lake.read("gold", "a")) == [1]
        lake.write("gold", "b", _numbers(spark, turn, turn))
        assert lake.publish() == turn
    assert _read(lake.read("gold", "a")) == [2] and _read(lake.read("gold", "b")) == [2, 2]
    assert _read(lake.read("gold", "a", version=1)) == [1] and lake.versions() == [1, 2]
    lake.write("gold", "a", _numbers(spark, 3))
    lake.discard()
    assert _read(lake.read("gold", "a")) == [2]
    assert len(list((tmp_path / "lake" / "gold" / "a").iterdir())) == 2
    lake.write("gold", "a", _numbers(spark, 9))
    lake.staged.clear()  # a build that was killed
    assert lake.remove_old(-1) == 1 and _read(lake.read("gold", "a", version=1)) == [1]
    with pytest.raises(ValueError, match="not published"):
        lake.read("gold", "c")


def test_a_reader_keeps_its_version(spark, tmp_path):
    lake = Lake(spark, root=str(tmp_path / "lake"))
    lake.write("gold", "a", _numbers(spark, 1))
    lake.publish()
    before = lake.read("gold", "a")
    lake.write("gold", "a", _numbers(spark, 2))
    lake.publish()
    assert _read(before) == [1] and _read(lake.read("gold", "a")) == [2]


def test_views_outlive_the_session(spark, tmp_path):
    other = spark.newSession()
    for lake in (Lake(spark, root=str(tmp_path / "lake")), Lake(spark, schemas={"silver": "views_of_test"})):
        lake.create_schemas()
        lake.write("silver", "t", _numbers(spark, 1, 2))
        lake.view("silver", "v", "select n + 1 as n from {t}", {"t": ("silver", "t")})
        lake.publish()
        reader = Lake(other, root=lake.root, schemas=lake.schemas)
        assert _read(reader.read("silver", "v")) == [2, 3]
        lake.write("silver", "t", _numbers(spark, 5))
        lake.publish()
        assert _read(reader.read("silver", "v")) == [6]
    assert _read(other.table("views_of_test.v")) == [6]
    assert lake.remove_old() == 1
    left = [t.name for t in spark.catalog.listTables("views_of_test") if VERSION_MARK in t.name]
    assert len(left) == 1 and _read(other.table("views_of_test.t")) == [5]


def test_silver_statement_equals_the_operators(spark):
    rows = latest_wins(sensor_rows(spark.read.parquet(EVENTS)))
    rows.createOrReplaceTempView("staging_of_test")
    by_sql, by_columns = spark.sql(silver_sql("staging_of_test")), enrich(rows)
    assert dict(by_sql.dtypes) == dict(by_columns.dtypes)
    by_sql = by_sql.select(*by_columns.columns)
    assert by_sql.exceptAll(by_columns).isEmpty() and by_columns.exceptAll(by_sql).isEmpty()


def test_live_batches_reach_all_tables_or_none(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "live")
    messages = sensor_payload(sensor_rows(spark.read.parquet(EVENTS))).select("raw_data")
    damaged = messages.selectExpr("left(raw_data, length(raw_data) - 1) as raw_data").limit(3)
    whole = messages.unionByName(damaged)
    broken = {**LIVE_TABLES, "quarantine": lambda checked: checked.selectExpr("raise_error('disk full') as raw_data")}
    with monkeypatch.context() as patched:
        patched.setattr("tachoflow.streaming.live.LIVE_TABLES", broken)
        with pytest.raises(Exception, match="disk full"):
            add_messages(whole, 0, root, "s", raw="raw_data")
    assert live_tables(spark, root).runs() == []
    for _ in range(2):
        add_messages(whole, 0, root, "s", raw="raw_data")
    assert live_table(spark, root, "telemetry_live").count() == messages.count()
    assert live_table(spark, root, "quarantine").count() == 3
    assert "Scan" in live_table(spark, root, "stream_alerts")._jdf.queryExecution().executedPlan().toString()
    # The same number of another stream is another batch.
    add_messages(damaged, 0, root, "other", raw="raw_data")
    assert live_table(spark, root, "quarantine").count() == 6


def test_runs_of_the_log_stay_few_and_give_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = sensor_rows(spark.read.parquet(EVENTS))
    batches = [rows.where(f"id % 10 = {k}") for k in range(10)]
    for number, batch in enumerate(batches):
        merge_batch(batch, number, path, runs_per_level=3)
    log = log_of(spark, path, 3)
    assert [r["level"] for r in log.runs()] == [2, 0]
    folders = {f.rsplit("/", 2)[1] for f in log.read(LOG).inputFiles()}
    per_date = [f for f in log.read(LOG).inputFiles() if f"/{sorted(folders)[0]}/" in f]
    assert len(per_date) <= 2 * 2
    expected = latest_wins(rows)

    def same():
        got = current_rows(spark, path).drop("event_date").select(*expected.columns)
        return got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()

    assert same()
    for number, batch in enumerate(batches):
        merge_batch(batch, number, path, runs_per_level=3)
    assert same() and [r["level"] for r in log.runs()] == [2, 0]
    assert log.compact() == 0


def test_a_crash_in_a_merge_leaves_the_runs(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    rows = sensor_rows(spark.read.parquet(EVENTS))
    for number in range(2):
        merge_batch(rows.where(f"id % 2 = {number}"), number, path, runs_per_level=3)
    before = log_of(spark, path).runs()
    with monkeypatch.context() as patched:
        def crash(*_):
            raise RuntimeError("lost")

        patched.setattr("tachoflow.streaming.runs.replace_runs", crash)
        with pytest.raises(RuntimeError):
            log_of(spark, path, 2).compact()
    assert log_of(spark, path).runs() == before
    assert current_rows(spark, path).count() == latest_wins(rows).count()
    assert log_of(spark, path, 2).compact() == 1
    assert current_rows(spark, path).count() == latest_wins(rows).count()
    assert json.dumps(log_of(spark, path).runs()).count("run=") == 1


def test_live_batch_is_dealt_by_its_size(spark, tmp_path):
    """A part of a batch has the size asked for, however much comes and in however few files."""
    messages = sensor_payload(sensor_rows(spark.read.parquet(EVENTS))).select("raw_data")
    many = messages.crossJoin(spark.range(8).toDF("copy")).selectExpr("concat(left(raw_data, length(raw_data) - 1), ',\"copy\":', copy, '}') as raw_data")
    sizes = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"}
    before = {key: spark.conf.get(key) for key in (*sizes, SIZED_CACHE)}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        parts = {}
        for name, rows in (("few", messages.limit(20)), ("many", many)):
            add_messages(rows.coalesce(1), 0, str(tmp_path / name), "s", raw="raw_data")
            table = live_table(spark, str(tmp_path / name), "telemetry_live")
            assert table.count() == rows.count()
            parts[name] = len(table.inputFiles())
        assert parts["few"] <= 4 < 8 < parts["many"]
        assert spark.conf.get(SIZED_CACHE) == before[SIZED_CACHE]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
