"""Fault codes and warning lamps recomputed from recorded sensor values.

Recorded values are rounded, so a reading right at a limit may differ from the flag
recorded with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_FAULT = "NONE"
# Fault limits in order of precedence, then lamp limits and gear limits.
OVERHEAT_ABOVE = 115.0
OIL_PRESSURE_BELOW = 0.5
BATTERY_BELOW = 10.0
FUEL_BELOW = 8.0
TYRE_BELOW = 28.0
LOW_FUEL_LAMP_BELOW = 10.0
CHECK_ENGINE_TEMP_ABOVE = 112.0
CHECK_ENGINE_OIL_BELOW = 1.4
STANDING_BELOW = 1.0
STANDING_STATES = ("IDLE", "STOPPED")
GEAR_SPEED_BELOW = (20.0, 40.0, 60.0, 85.0, 115.0)


def classify_fault(
    engine_temp: Column, oil_pressure: Column, battery: Column, fuel: Column, tyres: Sequence[Column]
) -> Column:
    """The first fault whose limit is crossed."""
    return (
        F.when(engine_temp > OVERHEAT_ABOVE, "ENGINE_OVERHEAT")
        .when(oil_pressure < OIL_PRESSURE_BELOW, "LOW_OIL_PRESSURE")
        .when(battery < BATTERY_BELOW, "LOW_BATTERY")
        .when(fuel < FUEL_BELOW, "LOW_FUEL")
        .when(F.least(*tyres) < TYRE_BELOW, "LOW_TYRE_PRESSURE")
        .otherwise(NO_FAULT)
    )


def fault_flag(fault_type: Column) -> Column:
    return fault_type != NO_FAULT


def low_fuel_flag(fuel: Column) -> Column:
    return F.coalesce(fuel < LOW_FUEL_LAMP_BELOW, F.lit(False))


def check_engine_flag(engine_temp: Column, oil_pressure: Column) -> Column:
    hot_or_dry = (engine_temp > CHECK_ENGINE_TEMP_ABOVE) | (oil_pressure < CHECK_ENGINE_OIL_BELOW)
    return F.coalesce(hot_or_dry, F.lit(False))


def gear_from_speed(speed: Column, drive_state: Column) -> Column:
    """Gear 0 when standing, else the first gear whose speed limit is not reached."""
    chain = F.when((speed < STANDING_BELOW) & drive_state.isin(*STANDING_STATES), 0)
    for gear, limit in enumerate(GEAR_SPEED_BELOW, start=1):
        chain = chain.when(speed < limit, gear)
    return chain.otherwise(len(GEAR_SPEED_BELOW) + 1)
