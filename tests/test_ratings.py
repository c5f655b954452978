import pytest
from pyspark.sql import functions as F

from tachoflow.functions import ecu, ratings
from tachoflow.functions.numeric import exact_mean, round_half_up, share_percent
from tachoflow.functions.units import celsius_to_fahrenheit, fuel_consumed_litres


def _map(spark, build, values, kind="DOUBLE"):
    """Results of a column function over one-column rows, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"n INT, x {kind}")
    return [r[0] for r in df.orderBy("n").select(build(F.col("x"))).collect()]


def _tuples(spark, build, rows, width):
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "n INT, " + ", ".join(f"{c} DOUBLE" for c in names))
    return [r[0] for r in df.orderBy("n").select(build(*[F.col(c) for c in names])).collect()]


def test_categories(spark):
    assert _map(spark, ratings.speed_bucket, [0.0, 29.99, 30.0, 89.99, 90.0, None]) == [
        "city", "city", "suburban", "suburban", "highway", "highway"]
    assert _map(spark, ratings.is_moving, [0.0, 0.01, None]) == [False, True, False]
    assert _map(spark, ratings.thermal_stress, [7.99, 8.0, 17.99, 18.0, None]) == [
        "LOW", "NORMAL", "NORMAL", "HIGH", "HIGH"]
    assert _map(spark, ratings.engine_load, [1499.0, 1500.0, 4999.0, 5000.0, None]) == [
        "LOW_LOAD", "NORMAL_LOAD", "NORMAL_LOAD", "HIGH_LOAD", "HIGH_LOAD"]
    assert _map(spark, ratings.gear_group, [0, 1, 2, 3, 4, 5, -1, None], "INT") == [
        "PARKED", "LOW_GEAR", "LOW_GEAR", "MID_GEAR", "MID_GEAR", "HIGH_GEAR", "LOW_GEAR", "HIGH_GEAR"]


def test_engine_status(spark):
    rows = [(125.0, 900.0, 0.0), (90.0, 6800.0, 0.0), (115.0, 900.0, 20.0), (115.0, 900.0, 10.0),
            (105.0, 900.0, 0.0), (90.0, 5000.0, 0.0), (104.9, 900.0, 0.0), (90.0, None, 0.0), (None, 900.0, None),
            (115.0, 900.0, None)]

    def build(temp, rpm, delta):
        return ratings.engine_status(temp, rpm, ratings.thermal_stress(delta), ratings.engine_load(rpm))

    assert _tuples(spark, build, rows, 3) == [
        "CRITICAL", "CRITICAL", "CRITICAL", "WARNING", "WARNING", "WARNING", "NORMAL", "WARNING", "NORMAL", "CRITICAL"]


def test_other_statuses(spark):
    oil = [(1.1, 80.0), (1.3, 80.0), (1.31, 80.0), (2.0, 130.0), (2.0, 115.0), (2.0, 114.9), (None, None)]
    assert _tuples(spark, ratings.oil_status, oil, 2) == [
        "CRITICAL", "WARNING", "NORMAL", "CRITICAL", "WARNING", "NORMAL", "NORMAL"]
    assert _map(spark, ratings.battery_status, [10.5, 11.8, 11.81, None]) == ["CRITICAL", "WARNING", "NORMAL", "NORMAL"]
    assert _map(spark, ratings.fuel_status, [5.0, 15.0, 15.1, None]) == ["CRITICAL", "WARNING", "NORMAL", "NORMAL"]
    tyres = [(25.9, 60.0, 0.0, 0.0), (26.0, 60.0, 0.0, 0.0), (28.0, 60.0, 0.0, 0.0),
             (30.0, 90.1, 0.0, 0.0), (30.0, 90.0, 0.0, 0.0), (30.0, 80.0, 0.0, 0.0),
             (30.0, 60.0, 7.1, 0.0), (30.0, 60.0, 7.0, 0.0), (30.0, 60.0, 4.0, 0.0),
             (30.0, 60.0, 0.0, 15.1), (30.0, 60.0, 0.0, 15.0), (30.0, 60.0, 0.0, 10.0),
             (None, None, None, None), (None, None, 8.0, None)]
    assert _tuples(spark, ratings.tyre_status, tyres, 4) == ["CRITICAL", "WARNING", "NORMAL"] * 4 + ["NORMAL", "CRITICAL"]


def test_missing_wheel(spark):
    rows = [(30.0, 31.0, 32.0, None), (30.0, 31.0, 32.0, 35.0)]
    assert _tuples(spark, lambda *w: ratings.wheel_mean(w), rows, 4) == [None, 32.0]
    assert _tuples(spark, lambda *w: ratings.wheel_spread(w), rows, 4) == [2.0, 5.0]


@pytest.mark.parametrize(
    "statuses, count, health, ready",
    [(["WARNING"] * 3 + ["NORMAL"] * 2, 3, "CRITICAL", False), (["WARNING"] + ["NORMAL"] * 4, 1, "WARNING", False),
     (["NORMAL"] * 5, 0, "NORMAL", True), (["NORMAL"] * 4 + ["CRITICAL"], 1, "CRITICAL", False)],
)
def test_vehicle_health(spark, statuses, count, health, ready):
    columns = [F.lit(s) for s in statuses]
    total = ratings.anomaly_count(columns)
    row = spark.range(1).select(total, ratings.vehicle_health(columns, total), ratings.ready_for_trip(total)).first()
    assert tuple(row) == (count, health, ready)


def test_rounding(spark):
    def rounded(places):
        return lambda _: F.expr(round_half_up("x", places))

    assert [str(v) for v in _map(spark, rounded(2), [1.005, 2.675, -1.005])] == ["1.01", "2.68", "-1.01"]
    assert [int(v) for v in _map(spark, rounded(0), [-2.5, 2.5])] == [-3, 3]


def test_exact_shares(spark):
    rows = [(1, 8), (1, 3), (2, 3), (0, 5), (5, 0), (None, 4), (1, 16), (80_000_000_001, 160_000_000_000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n INT, a BIGINT, b BIGINT").orderBy("n")
    shares = [r[0] for r in df.selectExpr(share_percent("a", "b")).collect()]
    assert [None if s is None else str(s) for s in shares] == [
        "12.50", "33.33", "66.67", "0.00", None, None, "6.25", "50.00"]
    means = [r[0] for r in df.limit(3).selectExpr(exact_mean("a", "b")).collect()]
    assert [str(m) for m in means] == ["0.13", "0.33", "0.67"]


def test_units(spark):
    assert _map(spark, celsius_to_fahrenheit, [0.0, 100.0, None]) == [32.0, 212.0, None]
    assert _map(spark, fuel_consumed_litres, [7200.0]) == [1.0]
    assert _map(spark, lambda x: fuel_consumed_litres(x, 2.0), [3600.0]) == [2.0]


def test_fault_codes(spark):
    rows = [(115.1, 3.0, 12.0, 7.9, 30.0), (115.0, 0.4, 9.0, 50.0, 30.0), (90.0, 0.5, 9.9, 50.0, 30.0),
            (90.0, 3.0, 10.0, 7.9, 20.0), (90.0, 3.0, 12.0, 8.0, 27.9), (90.0, 3.0, 12.0, 8.0, 28.0)]

    def build(temp, oil, battery, fuel, tyre):
        return ecu.classify_fault(temp, oil, battery, fuel, [tyre, F.lit(31.0), F.lit(31.0), F.lit(31.0)])

    assert _tuples(spark, build, rows, 5) == [
        "ENGINE_OVERHEAT", "LOW_OIL_PRESSURE", "LOW_BATTERY", "LOW_FUEL", "LOW_TYRE_PRESSURE", "NONE"]


def test_lamps_and_gear(spark):
    assert _map(spark, ecu.low_fuel_flag, [9.99, 10.0]) == [True, False]
    assert _tuples(spark, ecu.check_engine_flag, [(112.1, 2.0), (112.0, 1.39), (112.0, 1.4)], 2) == [True, True, False]
    speeds = [0.5, 0.5, 19.9, 20.0, 40.0, 60.0, 85.0, 115.0]
    states = ["IDLE", "BRAKING"] + ["CRUISING"] * 6
    df = spark.createDataFrame(list(zip(range(8), speeds, states)), "n INT, v DOUBLE, s STRING").orderBy("n")
    assert [r[0] for r in df.select(ecu.gear_from_speed(F.col("v"), F.col("s"))).collect()] == [0, 1, 1, 2, 3, 4, 5, 6]
