"""Silver: staging plus unit conversions, driving categories and health ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratings
from ..functions.units import TICK_SECONDS, celsius_to_fahrenheit, fuel_consumed_litres
from ..schema import SUBSYSTEM_STATUS, TYRE_PRESSURES, TYRE_TEMPS

HEAT_SENSORS = ("engine_temp", "oil_temp", *TYRE_TEMPS)


def _columns(names) -> list:
    return [F.col(name) for name in names]


def add_conversions(df: DataFrame) -> DataFrame:
    """Fahrenheit temperatures and litres used in the tick."""
    new = {f"{name}_f": celsius_to_fahrenheit(F.col(name)) for name in HEAT_SENSORS}
    new["fuel_consumed_this_tick"] = fuel_consumed_litres(F.col("fuel_flow"))
    return df.withColumns(new)


def add_driving_context(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "speed_bucket": ratings.speed_bucket(F.col("speed_kmh")),
            "is_moving": ratings.is_moving(F.col("speed_kmh")),
            "thermal_delta": F.col("engine_temp") - F.col("oil_temp"),
        }
    )


def add_metrics(df: DataFrame) -> DataFrame:
    pressures, temps = _columns(TYRE_PRESSURES), _columns(TYRE_TEMPS)
    return df.withColumns(
        {
            "avg_tyre_pressure": ratings.wheel_mean(pressures),
            "avg_tyre_temp": ratings.wheel_mean(temps),
            "tyre_pressure_imbalance": ratings.wheel_spread(pressures),
            "tyre_temp_imbalance": ratings.wheel_spread(temps),
            "thermal_stress": ratings.thermal_stress(F.col("thermal_delta")),
            "engine_load": ratings.engine_load(F.col("rpm")),
            "gear_group": ratings.gear_group(F.col("gear")),
        }
    )


def add_subsystem_health(df: DataFrame) -> DataFrame:
    engine = ratings.engine_status(*_columns(("engine_temp", "rpm", "thermal_stress", "engine_load")))
    tyres = ratings.tyre_status(
        *_columns(
            ("avg_tyre_pressure", "avg_tyre_temp", "tyre_pressure_imbalance", "tyre_temp_imbalance")
        )
    )
    return df.withColumns(
        {
            "engine_status": engine,
            "oil_status": ratings.oil_status(F.col("oil_pressure"), F.col("oil_temp")),
            "battery_status": ratings.battery_status(F.col("battery_voltage")),
            "fuel_status": ratings.fuel_status(F.col("fuel_level")),
            "tyre_status": tyres,
        }
    )


def add_vehicle_health(df: DataFrame) -> DataFrame:
    statuses = _columns(SUBSYSTEM_STATUS.values())
    counted = df.withColumn("anomaly_count", ratings.anomaly_count(statuses))
    return counted.withColumns(
        {
            "vehicle_health": ratings.vehicle_health(statuses, F.col("anomaly_count")),
            "ready_for_trip": ratings.ready_for_trip(F.col("anomaly_count")),
        }
    )


def enrich(staging: DataFrame) -> DataFrame:
    """All derived columns, row for row, without a shuffle. Works on streams too."""
    steps = (
        add_conversions, add_driving_context, add_metrics, add_subsystem_health, add_vehicle_health
    )
    for step in steps:
        staging = step(staging)
    return staging


def _band_sql(value: str, bands: Sequence[tuple[float, str]], top: str) -> str:
    cases = " ".join(f"when {value} < {limit}D then '{label}'" for limit, label in bands)
    return f"case {cases} else '{top}' end"


def _rating_sql(critical: Sequence[str], warning: Sequence[str]) -> str:
    levels = zip((critical, warning), (ratings.CRITICAL, ratings.WARNING), strict=True)
    cases = " ".join(f"when {' or '.join(conditions)} then '{level}'" for conditions, level in levels)
    return f"case {cases} else '{ratings.NORMAL}' end"


def _limits_sql(*limits: tuple[str, Sequence[float]]) -> list[list[str]]:
    """Conditions ``<value and comparison> <limit>`` of the critical, then of the warning level."""
    return [[f"{compared} {pair[level]}D" for compared, pair in limits] for level in (0, 1)]


def _steps_sql() -> list[dict[str, str]]:
    """Columns that each step adds to those before it, as SQL."""
    engine_critical, engine_warning = _limits_sql(("engine_temp >=", ratings.ENGINE_TEMP_FROM))
    stressed = f"(thermal_stress = '{ratings.STRESS_TOP}' and engine_temp >= {ratings.ENGINE_STRESSED_TEMP_FROM}D)"
    statuses = list(SUBSYSTEM_STATUS.values())
    critical_from, warning_from = ratings.ANOMALIES_FROM
    context = {
        **{f"{name}_f": f"{name} * 9.0D / 5.0D + 32.0D" for name in HEAT_SENSORS},
        "fuel_consumed_this_tick": f"fuel_flow / 3600.0D * {TICK_SECONDS}D",
        "speed_bucket": _band_sql("speed_kmh", ratings.SPEED_BANDS, ratings.SPEED_TOP),
        "is_moving": "coalesce(speed_kmh > 0, false)",
        "thermal_delta": "engine_temp - oil_temp",
    }
    metrics = {
        **{
            f"avg_{kind}": f"({' + '.join(wheels)}) * {ratings.WHEEL_SHARE}D"
            for kind, wheels in (("tyre_pressure", TYRE_PRESSURES), ("tyre_temp", TYRE_TEMPS))
        },
        **{
            f"{kind}_imbalance": f"greatest({', '.join(wheels)}) - least({', '.join(wheels)})"
            for kind, wheels in (("tyre_pressure", TYRE_PRESSURES), ("tyre_temp", TYRE_TEMPS))
        },
        "thermal_stress": _band_sql("thermal_delta", ratings.STRESS_BANDS, ratings.STRESS_TOP),
        "engine_load": _band_sql("rpm", ratings.LOAD_BANDS, ratings.LOAD_TOP),
        "gear_group": "case when gear = 0 then 'PARKED' when gear <= 2 then 'LOW_GEAR' when gear <= 4 then 'MID_GEAR' else 'HIGH_GEAR' end",
    }
    health = {
        "engine_status": _rating_sql(
            [*engine_critical, f"rpm >= {ratings.ENGINE_RPM_CRITICAL_FROM}D", stressed],
            [*engine_warning, f"engine_load = '{ratings.LOAD_TOP}'"]),
        "oil_status": _rating_sql(*_limits_sql(("oil_pressure <=", ratings.OIL_PRESSURE_TO), ("oil_temp >=", ratings.OIL_TEMP_FROM))),
        "battery_status": _rating_sql(*_limits_sql(("battery_voltage <=", ratings.BATTERY_VOLTAGE_TO))),
        "fuel_status": _rating_sql(*_limits_sql(("fuel_level <=", ratings.FUEL_LEVEL_TO))),
        "tyre_status": _rating_sql(*_limits_sql(
            ("avg_tyre_pressure <", ratings.TYRE_PRESSURE_BELOW), ("avg_tyre_temp >", ratings.TYRE_TEMP_ABOVE),
            ("tyre_pressure_imbalance >", ratings.TYRE_PRESSURE_SPREAD_ABOVE), ("tyre_temp_imbalance >", ratings.TYRE_TEMP_SPREAD_ABOVE))),
    }
    anomalies = {"anomaly_count": " + ".join(f"cast({s} <> '{ratings.NORMAL}' as int)" for s in statuses)}
    vehicle = {
        "vehicle_health": _rating_sql(
            [f"'{ratings.CRITICAL}' in ({', '.join(statuses)})", f"anomaly_count >= {critical_from}"], [f"anomaly_count >= {warning_from}"]),
        "ready_for_trip": "anomaly_count = 0",
    }
    return [context, metrics, health, anomalies, vehicle]


def silver_sql(source: str) -> str:
    """One statement with the rows of ``enrich`` over a relation, for views that outlive the session."""
    text = source
    for step in _steps_sql():
        text = f"(select *, {', '.join(f'{sql} as {name}' for name, sql in step.items())} from {text})"
    return text[1:-1]
