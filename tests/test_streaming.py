import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from tachoflow.operators.staging import latest_wins
from tachoflow.schema import ALERT_COLUMNS, LIVE_COLUMNS
from tachoflow.session import scratch_dir
from tachoflow.sources.bronze import load_bronze, next_id, scan_bronze
from tachoflow.sources.sensors import sensor_payload, sensor_rows
from tachoflow.streaming.dedup import current_rows, dedup_stream, merge_batch
from tachoflow.streaming.ingest import consume_once
from tachoflow.streaming.live import append_stream, ingest_messages, stream_alerts, telemetry_live

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """A folder of JSON lines, and the readings they hold."""
    folder = str(tmp_path_factory.mktemp("messages") / "in")
    rows = sensor_rows(spark.read.parquet(EVENTS))
    sensor_payload(rows).select("raw_data").write.text(folder)
    return folder


def _drain(spark, folder, operator, tmp_path):
    stream = operator(ingest_messages(spark.readStream.text(folder)))
    target = str(tmp_path / "out")
    append_stream(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
    return spark.read.parquet(target)


@pytest.mark.parametrize(
    "operator, columns", [(telemetry_live, LIVE_COLUMNS), (stream_alerts, ALERT_COLUMNS)], ids=["live", "alerts"])
def test_stream_equals_batch(spark, messages, tmp_path, operator, columns):
    streamed = _drain(spark, messages, operator, tmp_path)
    batch = operator(ingest_messages(spark.read.text(messages)))
    assert tuple(batch.columns) == columns
    assert streamed.count() > 0
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def _fill(path, turn, rows=5):
    path.write_text("".join(f'{{"turn":{turn},"n":{n}}}\n' for n in range(rows)))


def test_only_new_files_are_consumed(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "bronze")
    inbox.mkdir()
    for turn in range(3):
        _fill(inbox / f"part{turn}.jsonl", turn)
        assert consume_once(spark, str(inbox), table) == 5
        assert consume_once(spark, str(inbox), table) == 0
        assert scan_bronze(spark, table).count() == 5 * (turn + 1)
    rows = scan_bronze(spark, table).orderBy("id").collect()
    assert [json.loads(r.raw_data)["turn"] for r in rows] == [t for t in range(3) for _ in range(5)]
    assert len({r.id for r in rows}) == 15
    times = [r.ingested_at for r in rows]
    assert times == sorted(times) and len(set(times)) == 3


def test_late_and_refilled_files_are_consumed(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "bronze")
    inbox.mkdir()
    _fill(inbox / "a.jsonl", 0)
    consume_once(spark, str(inbox), table)
    _fill(inbox / "old.jsonl", 1)
    os.utime(inbox / "old.jsonl", (1, 1_000_000))
    assert consume_once(spark, str(inbox), table) == 5
    _fill(inbox / "a.jsonl", 2, 7)
    assert consume_once(spark, str(inbox), table) == 7
    turns = [json.loads(r.raw_data)["turn"] for r in scan_bronze(spark, table).collect()]
    assert sorted(turns) == [0] * 5 + [1] * 5 + [2] * 7


def test_ids_grow_with_the_bytes_and_loads_may_meet(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "bronze")
    inbox.mkdir()
    ends = []
    for turn in range(6):
        _fill(inbox / f"{turn}.jsonl", turn)
        consume_once(spark, str(inbox), table, files_per_load=1)
        ends.append(next_id(spark, table))
    steps = {b - a for a, b in zip(ends, ends[1:])}
    assert len(steps) == 1
    with ThreadPoolExecutor(2) as pool:
        done = [pool.submit(load_bronze, spark, str(inbox / f"{k}.jsonl"), table) for k in (0, 1)]
    assert [d.result() for d in done] == [5, 5]
    assert scan_bronze(spark, table).count() == 40
    # A load that broke off before its manifest leaves nothing to see.
    spark.createDataFrame([(1, None, "x")], "id BIGINT, ingested_at TIMESTAMP, raw_data STRING").write.parquet(f"{table}/load=broken")
    assert scan_bronze(spark, table).count() == 40


def test_bad_line_stops_the_load_and_quarantine_resumes(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "bronze")
    inbox.mkdir()
    (inbox / "a.jsonl").write_text('{"n":1}\n{bad\n')
    with pytest.raises(Exception, match="Invalid JSON"):
        consume_once(spark, str(inbox), table)
    assert scan_bronze(spark, table).count() == 0
    assert consume_once(spark, str(inbox), table, quarantine=str(tmp_path / "bad")) == 1
    assert scan_bronze(spark, table).count() == 1
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def _readings(spark, rows):
    return spark.createDataFrame(
        rows, "id BIGINT, ingested_at TIMESTAMP, timestamp TIMESTAMP, tick INT, rpm DOUBLE")


def test_replayed_batches_change_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    day1, day2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    first = _readings(spark, [(1, day1, day1, 1, 1.0), (2, day1, day1, 1, 2.0), (3, day1, day2, 1, 3.0)])
    late = _readings(spark, [(1, day2, day1, 1, 9.0), (9, datetime(2023, 1, 1), day2, 1, 8.0), (4, day2, None, None, 7.0)])
    for batch_id, batch in ((0, first), (1, late), (1, late), (0, first)):
        merge_batch(batch, batch_id, path)
    rows = current_rows(spark, path)
    assert sorted(r.rpm for r in rows.collect()) == [3.0, 7.0, 9.0]
    pruned = rows.where("event_date = date'2024-01-02'")
    assert [r.rpm for r in pruned.collect()] == [3.0]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_stream_dedup_equals_batch_over_many_batches(spark, tmp_path):
    source = str(tmp_path / "src")
    rows = sensor_rows(spark.read.parquet(EVENTS))
    rows.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    target = str(tmp_path / "log")
    dedup_stream(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
    batches = spark.read.parquet(target).select("batch").distinct().count()
    assert batches == 3
    expected = latest_wins(rows)
    got = current_rows(spark, target).drop("event_date").select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second
