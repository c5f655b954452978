"""Unit conversions."""

from __future__ import annotations

from pyspark.sql import Column

# Fixed value: length of one tick in seconds used by the silver layer.
TICK_SECONDS = 0.5


def celsius_to_fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def fuel_consumed_litres(flow_per_hour: Column, dt_seconds: float = TICK_SECONDS) -> Column:
    return flow_per_hour / 3600.0 * dt_seconds
