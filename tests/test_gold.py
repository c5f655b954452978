import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tachoflow.operators import gold
from tachoflow.operators.silver import enrich
from tachoflow.operators.staging import latest_wins
from tachoflow.schema import FACT_COLUMNS
from tachoflow.sources.sensors import sensor_rows

EVENTS = "/root/testdata/sf0.001/events.parquet"
AGGREGATES = [
    gold.agg_vehicle_health, gold.agg_subsystem_health, gold.agg_driving_behavior,
    gold.agg_efficiency, gold.agg_trip_summary,
]
DIMENSIONS = [gold.dim_driving_states, gold.dim_gear_group, gold.dim_speed_bucket]


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "fact")
    rows = enrich(latest_wins(sensor_rows(spark.read.parquet(EVENTS))))
    gold.fct_vehicle_telemetry(rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rollup(spark, fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "rollup")
    gold.rollup_fact(fact).write.parquet(path)
    return spark.read.parquet(path)


def test_fact_columns(fact):
    assert tuple(fact.columns) == FACT_COLUMNS


@pytest.mark.parametrize("operator", AGGREGATES + DIMENSIONS, ids=lambda f: f.__name__)
def test_rollup_gives_the_same_rows_in_the_same_order(fact, rollup, operator):
    from_fact = operator(fact)
    assert from_fact.columns == operator(rollup).columns
    assert from_fact.collect() == operator(rollup).collect()


@pytest.mark.parametrize("operator", AGGREGATES + DIMENSIONS, ids=lambda f: f.__name__)
def test_no_rows(fact, rollup, operator):
    for empty in (fact.limit(0), rollup.limit(0)):
        rows = operator(empty).collect()
        if operator is gold.agg_trip_summary:
            values = rows[0].asDict()
            assert values.pop("telemetry_events") == 0
            assert set(values.values()) == {None}
        else:
            assert rows == []


def test_zero_fuel_and_distance(fact):
    still = fact.withColumns({"odometer_km": F.lit(5.0), "fuel_consumed_this_tick": F.lit(0.0)})
    row = gold.agg_trip_summary(still).first()
    assert row.total_distance_km == 0 and row.km_per_litre is None
    assert {r.litres_per_km for r in gold.agg_efficiency(still).collect()} == {None}


def test_subsystem_counts_equal_the_unpivoted_rows(fact):
    tall = gold.unpivot_subsystems(fact)
    assert tall.count() == 5 * fact.count()
    grouped = {(r.subsystem, r.status): r["count"] for r in tall.groupBy("subsystem", "status").count().collect()}
    for row in gold.agg_subsystem_health(fact).collect():
        for level in ("normal", "warning", "critical"):
            assert row[f"{level}_events"] == grouped.get((row.subsystem, level.upper()), 0)


def test_fixed_orders(fact):
    assert [r.vehicle_health for r in gold.agg_vehicle_health(fact).collect()] == ["CRITICAL", "WARNING", "NORMAL"]
    assert [r.speed_bucket for r in gold.agg_efficiency(fact).collect()] == ["city", "suburban", "highway"]
    states = [r.drive_state for r in gold.dim_driving_states(fact).collect()]
    assert states == ["ACCELERATING", "BRAKING", "CRUISING", "IDLE", "STOPPED", None]
    rates = [r.critical_rate for r in gold.agg_subsystem_health(fact).collect()]
    assert rates == sorted(rates, reverse=True)


def test_load_share_stays_zero(fact):
    assert {float(r.high_engine_load_percentage) for r in gold.agg_efficiency(fact).collect()} == {0.0}


def test_scans_read_only_the_columns_used(fact):
    plan = plan_of(gold.agg_subsystem_health(fact))
    schema = plan[plan.index("ReadSchema"):]
    assert "rpm" not in schema and "engine_status" in schema
    assert plan.count("FileScan") == 1


def test_enrichment_needs_no_shuffle(spark):
    readings = sensor_rows(spark.read.parquet(EVENTS))
    assert "Exchange" not in plan_of(enrich(readings))


def test_hot_category_is_aggregated_before_the_shuffle(fact):
    plan = plan_of(gold.agg_vehicle_health(fact))
    assert "partial_avg" in plan and "partial_count" in plan


def test_null_state_is_its_own_group(fact):
    rows = [r for r in gold.agg_driving_behavior(fact).collect() if r.drive_state is None]
    assert rows and sum(r.total_events for r in rows) == fact.where("drive_state is null").count()


def test_seed(spark):
    from tachoflow.sources.seeds import SEED_FILE, seed_drive_states

    packaged, read = seed_drive_states(spark), seed_drive_states(spark, str(SEED_FILE))
    assert packaged.schema == read.schema and packaged.collect() == read.collect()
    assert packaged.count() == 5 and packaged.where("is_moving").count() == 3
