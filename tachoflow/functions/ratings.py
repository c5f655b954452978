"""Driving categories and health ratings of one reading.

A NULL input matches no limit, so it lands in the last band of a category and in
NORMAL for a rating. That routing is part of the published contract.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NORMAL, WARNING, CRITICAL = "NORMAL", "WARNING", "CRITICAL"
HEALTH_ORDER = (CRITICAL, WARNING, NORMAL)

# Category bands. Each pair is (exclusive upper limit, label).
SPEED_BANDS, SPEED_TOP = ((30.0, "city"), (90.0, "suburban")), "highway"
STRESS_BANDS, STRESS_TOP = ((8.0, "LOW"), (18.0, "NORMAL")), "HIGH"
LOAD_BANDS, LOAD_TOP = ((1500.0, "LOW_LOAD"), (5000.0, "NORMAL_LOAD")), "HIGH_LOAD"
SPEED_ORDER = ("city", "suburban", "highway")
# Rating limits, as (critical, warning).
ENGINE_TEMP_FROM = (125.0, 105.0)
ENGINE_STRESSED_TEMP_FROM = 115.0
ENGINE_RPM_CRITICAL_FROM = 6800.0
OIL_PRESSURE_TO = (1.1, 1.3)
OIL_TEMP_FROM = (130.0, 115.0)
BATTERY_VOLTAGE_TO = (10.5, 11.8)
FUEL_LEVEL_TO = (5.0, 15.0)
TYRE_PRESSURE_BELOW = (26.0, 28.0)
TYRE_TEMP_ABOVE = (90.0, 80.0)
TYRE_PRESSURE_SPREAD_ABOVE = (7.0, 4.0)
TYRE_TEMP_SPREAD_ABOVE = (15.0, 10.0)
# Number of abnormal subsystems that makes the vehicle CRITICAL / WARNING.
ANOMALIES_FROM = (3, 1)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _band(value: Column, bands: Sequence[tuple[float, str]], top: str) -> Column:
    chain = F
    for limit, label in bands:
        chain = chain.when(value < limit, label)
    return chain.otherwise(top)


def _rating(critical: Sequence[Column], warning: Sequence[Column]) -> Column:
    return F.when(_any(critical), CRITICAL).when(_any(warning), WARNING).otherwise(NORMAL)


def speed_bucket(speed: Column) -> Column:
    return _band(speed, SPEED_BANDS, SPEED_TOP)


def is_moving(speed: Column) -> Column:
    return F.coalesce(speed > 0, F.lit(False))


def thermal_stress(thermal_delta: Column) -> Column:
    return _band(thermal_delta, STRESS_BANDS, STRESS_TOP)


def engine_load(rpm: Column) -> Column:
    return _band(rpm, LOAD_BANDS, LOAD_TOP)


def gear_group(gear: Column) -> Column:
    return (
        F.when(gear == 0, "PARKED")
        .when(gear <= 2, "LOW_GEAR")
        .when(gear <= 4, "MID_GEAR")
        .otherwise("HIGH_GEAR")
    )


# One of four wheels. Exact, so multiplying equals dividing by four.
WHEEL_SHARE = 0.25


def wheel_mean(wheels: Sequence[Column]) -> Column:
    """Mean of the four wheels; NULL as soon as one is missing."""
    return reduce(lambda a, b: a + b, wheels) * WHEEL_SHARE


def wheel_spread(wheels: Sequence[Column]) -> Column:
    """Highest minus lowest wheel; missing wheels are skipped."""
    return F.greatest(*wheels) - F.least(*wheels)


def engine_status(temp: Column, rpm: Column, stress: Column, load: Column) -> Column:
    critical_temp, warning_temp = ENGINE_TEMP_FROM
    stressed = (stress == STRESS_TOP) & (temp >= ENGINE_STRESSED_TEMP_FROM)
    return _rating(
        [temp >= critical_temp, rpm >= ENGINE_RPM_CRITICAL_FROM, stressed],
        [temp >= warning_temp, load == LOAD_TOP],
    )


def oil_status(pressure: Column, temp: Column) -> Column:
    levels = [[pressure <= p, temp >= t] for p, t in zip(OIL_PRESSURE_TO, OIL_TEMP_FROM)]
    return _rating(*levels)


def battery_status(voltage: Column) -> Column:
    return _rating(*[[voltage <= limit] for limit in BATTERY_VOLTAGE_TO])


def fuel_status(level: Column) -> Column:
    return _rating(*[[level <= limit] for limit in FUEL_LEVEL_TO])


def tyre_status(
    mean_pressure: Column, mean_temp: Column, pressure_spread: Column, temp_spread: Column
) -> Column:
    limits = zip(
        TYRE_PRESSURE_BELOW, TYRE_TEMP_ABOVE, TYRE_PRESSURE_SPREAD_ABOVE, TYRE_TEMP_SPREAD_ABOVE
    )
    levels = [
        [mean_pressure < low, mean_temp > hot, pressure_spread > dp, temp_spread > dt]
        for low, hot, dp, dt in limits
    ]
    return _rating(*levels)


def anomaly_count(statuses: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [(s != NORMAL).cast("int") for s in statuses])


def vehicle_health(statuses: Sequence[Column], anomalies: Column) -> Column:
    critical_from, warning_from = ANOMALIES_FROM
    return _rating(
        [F.lit(CRITICAL).isin(*statuses), anomalies >= critical_from],
        [anomalies >= warning_from],
    )


def ready_for_trip(anomalies: Column) -> Column:
    """All subsystems are NORMAL."""
    return anomalies == 0
