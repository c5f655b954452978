from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import plan_of
from tachoflow.operators import quality

START = datetime(2024, 5, 1)


def test_null_checks(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a INT, b STRING")
    assert {r.column_name: r.failures for r in quality.null_counts(df, ["a", "b"]).collect()} == {"a": 1, "b": 2}
    assert quality.null_rows(df, "b").count() == 2


def test_duplicates_count_null_keys_too(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "timestamp INT, tick INT")
    found = {(r.timestamp, r.tick): r.occurrences for r in quality.duplicate_report(df).collect()}
    assert found == {(1, 1): 2, (None, 3): 2}
    assert "partial_count" in plan_of(quality.duplicate_report(df))


def test_accepted_values(spark):
    df = spark.createDataFrame([("NORMAL",), (None,), ("X",), ("X",)], "s STRING")
    found = quality.unexpected_values(df, "s", ("NORMAL",)).collect()
    assert [(r.value, r.occurrences) for r in found] == [("X", 2)]


def test_report_has_ten_checks(spark):
    staging = spark.createDataFrame(
        [(START, 1, 1.0, None, 5.0), (START, 1, 1.0, 2.0, 5.0)],
        "timestamp TIMESTAMP, tick INT, rpm DOUBLE, speed_kmh DOUBLE, fuel_level DOUBLE",
    )
    fact = spark.createDataFrame(
        [(START, 1, "NORMAL", "city"), (START, None, "BAD", "city"), (START, 2, "WORSE", "moon")],
        "timestamp TIMESTAMP, tick INT, vehicle_health STRING, speed_bucket STRING",
    )
    report = quality.quality_report(staging, fact)
    # One scan and one grouping of each table.
    assert plan_of(report).count("Scan ExistingRDD") == 2
    rows = report.collect()
    assert len(rows) == 10
    assert {(r.table_name, r.check_name, r.column_name): r.failures for r in rows if r.failures} == {
        ("staging", "unique_combination", "timestamp,tick"): 1,
        ("staging", "not_null", "speed_kmh"): 1,
        ("fact", "not_null", "tick"): 1,
        ("fact", "accepted_values", "vehicle_health"): 2,
        ("fact", "accepted_values", "speed_bucket"): 1,
    }


def _violations(rows):
    """Brute force over rows sorted by (timestamp, id), NULL last."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or START, r[1]))
    pairs = zip(ordered, ordered[1:])
    return {(b[1], b[2], a[2]) for a, b in pairs if a[2] is not None and b[2] is not None and b[2] <= a[2]}


def test_tick_order_with_one_timestamp_holding_most_rows(spark):
    rows = []
    for i in range(3000):
        at = START if i % 2 else (START + timedelta(seconds=i % 700) if i % 11 else None)
        rows.append((at, i, None if i % 97 == 0 else (i * 7919) % 1000))
    df = spark.createDataFrame(rows, "timestamp TIMESTAMP, id BIGINT, tick INT").repartition(5)
    for chunks in (1, 7, 64):
        got = {(r.id, r.tick, r.previous_tick) for r in quality.tick_order(df, chunks).collect()}
        assert got == _violations(rows)


def test_tick_order_of_an_ordered_table(spark):
    df = spark.range(1000).select(
        F.timestamp_seconds("id").alias("timestamp"), "id", F.col("id").cast("int").alias("tick"))
    assert quality.tick_order(df).count() == 0
    assert quality.tick_order(df.limit(0)).count() == 0


def test_distribution_needs_no_single_task(spark):
    df = spark.createDataFrame([("IDLE",)] * 3 + [(None,)], "drive_state STRING")
    shares = quality.drive_state_distribution(df)
    assert {r.drive_state: (r.events, float(r.percentage)) for r in shares.collect()} == {
        "IDLE": (3, 75.0), None: (1, 25.0)}
    plan = plan_of(shares)
    assert "Window" not in plan and "Subquery" in plan


def test_sensor_statistics(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0), (None, 2.0)], "rpm DOUBLE, throttle DOUBLE")
    stats = quality.sensor_statistics(df)
    rows = {r.sensor: r for r in stats.collect()}
    assert set(rows) == {"rpm", "throttle"}
    assert (rows["rpm"].readings, rows["rpm"].min_value, rows["rpm"].max_value) == (2, 1.0, 3.0)
    assert (float(rows["rpm"].mean_value), float(rows["rpm"].stddev_value)) == (2.0, 1.4142)
    assert float(rows["throttle"].stddev_value) == 0.0
