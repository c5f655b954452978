import json

import pytest

from conftest import plan_of
from tachoflow.operators.quality import duplicate_keys
from tachoflow.plans.batch import FACT, GOLD_TABLES, SILVER, STAGING, QualityError, build
from tachoflow.plans.jobs import RAW, run_batch, start_live
from tachoflow.plans.lake import Lake
from tachoflow.schema import EVENT_KEY
from tachoflow.session import sizing_conf
from tachoflow.sources.bronze import load_bronze, scan_bronze


def _message(number, /, **changes):
    tick = number
    reading = {
        "timestamp": f"2024-05-01T10:00:{tick:02d}+00:00", "tick": tick, "rpm": 1500.0, "speed_kmh": 50.0,
        "engine_temp": 90.0, "oil_temp": 80.0, "oil_pressure": 2.0, "throttle": 10.0, "fuel_level": 50.0,
        "fuel_flow": 3.6, "battery_voltage": 13.0, "brake_pressure": 0.0, "odometer_km": tick * 1.5,
        "trip_km": tick * 1.5, "gear": 3, "drive_state": "CRUISING", "fault_active": False, "fault_type": "NONE",
        "tyre_pressure": [32.0] * 4, "tyre_temp": [40.0] * 4,
    }
    return json.dumps({**reading, **changes})


def _load(spark, tmp_path, *lines):
    source, table = tmp_path / "in.jsonl", str(tmp_path / "bronze")
    source.write_text("\n".join(lines))
    load_bronze(spark, str(source), table)
    return scan_bronze(spark, table)


def test_layers_in_the_catalog(spark, tmp_path):
    lake = Lake(spark, schemas={"gold": " marts "})
    bronze = _load(spark, tmp_path, *[_message(t) for t in range(1, 5)], _message(4, engine_temp=126.0))
    report = build(lake, bronze, staging_buckets=4)
    assert len(report) == 10 and not any(r.failures for r in report)
    assert {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()} >= {"bronze", "silver", "marts"}
    tables = {t.tableName for t in spark.sql("SHOW TABLES IN marts").collect() if not t.isTemporary}
    assert tables >= {FACT, *GOLD_TABLES}
    summary = spark.table("marts.agg_trip_summary").first()
    assert (summary.telemetry_events, float(summary.total_distance_km)) == (4, 4.5)
    assert (summary.critical_events, float(summary.ready_trip_rate)) == (1, 75.0)
    assert float(summary.total_fuel_consumed_l) == 0.0 and float(summary.km_per_litre) == 2250.0
    assert len(spark.table(SILVER).columns) == 60
    assert len(spark.table(f"marts.{FACT}").columns) == 34
    # Stored by key, so the uniqueness check moves no rows.
    assert "Exchange" not in plan_of(duplicate_keys(lake.read("silver", STAGING), EVENT_KEY))
    again = build(lake, bronze)
    assert again == report
    assert spark.table("marts.agg_trip_summary").first() == summary


def test_failed_checks_leave_gold_untouched(spark, tmp_path):
    lake = Lake(spark, root=str(tmp_path / "lake"))
    build(lake, _load(spark, tmp_path, _message(1)))
    bronze = _load(spark, tmp_path, _message(2, rpm=None))
    with pytest.raises(QualityError, match="not_null on staging.rpm: 1"):
        build(lake, bronze)
    assert lake.read("gold", "agg_trip_summary").first().telemetry_events == 1
    report = build(lake, bronze, strict=False)
    assert sum(r.failures for r in report) == 1
    assert lake.read("gold", "agg_trip_summary").first().telemetry_events == 2


def test_layer_names(spark):
    assert Lake(spark, root="/r/").path("silver", "t") == "/r/silver/t"
    assert Lake(spark, schemas={"silver": "clean"}).table("silver", "t") == "clean.t"
    with pytest.raises(ValueError):
        Lake(spark).schema_of("platinum")
    with pytest.raises(ValueError):
        Lake(spark).path("gold", "t")


def test_jobs_process_only_what_is_new(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "tables")
    inbox.mkdir()
    (inbox / "1.jsonl").write_text(_message(1) + "\n" + _message(2, engine_temp=110.0, fault_active=True) + "\n")
    assert len(run_batch(spark, str(inbox), root)) == 10
    (inbox / "2.jsonl").write_text(_message(2) + "\n" + _message(3) + "\n")
    run_batch(spark, str(inbox), root)
    lake = Lake(spark, root=root)
    assert scan_bronze(spark, lake.path("bronze", RAW)).count() == 4
    # The reading that came again in the second file replaced the faulty one.
    summary = lake.read("gold", "agg_trip_summary").first()
    assert (summary.telemetry_events, summary.normal_events) == (3, 3)
    assert lake.read("silver", "drive_state_labels").count() == 5
    for query in start_live(spark, str(inbox), root, availableNow=True):
        query.awaitTermination()
    assert spark.read.parquet(f"{root}/live/telemetry_live").count() == 4
    alert = spark.read.parquet(f"{root}/live/stream_alerts").first()
    assert (alert.tick, alert.engine_status, alert.severity, alert.min_tyre_pressure) == (2, "WARNING", "WARNING", 32.0)


def test_live_survives_bad_messages(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "tables")
    inbox.mkdir()
    bad = ["{bad", _message(2, tick="3.0"), _message(3, gear="third"), _message(4) + " junk", _message(5, timestamp="noon")]
    (inbox / "1.jsonl").write_text("\n".join([_message(1), "", *bad]) + "\n")
    for lines in ([], [_message(6, rpm="1500.5", fuel_level="", ignition_on="on")]):
        if lines:
            (inbox / "2.jsonl").write_text("\n".join(lines))
        for query in start_live(spark, str(inbox), root, availableNow=True):
            query.awaitTermination()
    live = {r.tick: r for r in spark.read.parquet(f"{root}/live/telemetry_live").collect()}
    assert set(live) == {1, 6} and live[6].rpm == 1500.5
    assert sorted(r.raw_data for r in spark.read.parquet(f"{root}/live/quarantine").collect()) == sorted(bad)


def test_sizes_grow_with_the_input():
    small, large = sizing_conf(1 << 30), sizing_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == 102400
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 1 << 30
