"""Gold: the fact table, its dimensions and the health, driving and trip aggregates.

Each aggregate takes either fact rows or the rollup of them (``rollup_fact``): a table
of mergeable sums, counts and extremes per driving and health category, at most a few
hundred rows per drive state. Both give the same result; the rollup lets one scan of
the fact feed all gold tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import LIMBS, exact_sum, joined, limb_sums
from ..functions.numeric import exact_mean, guarded_ratio, round_half_up, share_percent
from ..functions.ratings import CRITICAL, HEALTH_ORDER, NORMAL, SPEED_ORDER, WARNING
from ..schema import FACT_COLUMNS, SUBSYSTEM_STATUS

ROLLUP_KEYS = ("vehicle_health", "speed_bucket", "drive_state", "engine_load", "gear_group")
AVERAGED = (
    "speed_kmh", "rpm", "throttle", "engine_temp", "oil_temp", "oil_pressure", "thermal_delta",
    "battery_voltage", "fuel_level", "fuel_consumed_this_tick", "trip_km", "avg_tyre_pressure",
    "avg_tyre_temp", "tyre_pressure_imbalance", "tyre_temp_imbalance",
)
LOWEST = ("odometer_km", "fuel_level")
HIGHEST = ("odometer_km", "trip_km", "speed_kmh", "engine_temp")


# Conditions whose events are counted. The load category is 'HIGH_LOAD', so the share of
# 'HIGH' is 0; it is published as defined.
FLAGS = {
    "normal": f"vehicle_health = '{NORMAL}'",
    "warning": f"vehicle_health = '{WARNING}'",
    "critical": f"vehicle_health = '{CRITICAL}'",
    "failing": f"vehicle_health <> '{NORMAL}'",
    "anomalous": "anomaly_count > 0",
    "ready": "ready_for_trip",
    "not_ready": "not ready_for_trip",
    "high_load": "engine_load = 'HIGH'",
}
for _status in SUBSYSTEM_STATUS.values():
    FLAGS[f"{_status}_normal"] = f"{_status} = '{NORMAL}'"
    FLAGS[f"{_status}_warning"] = f"{_status} = '{WARNING}'"
    FLAGS[f"{_status}_critical"] = f"{_status} = '{CRITICAL}'"
    FLAGS[f"{_status}_failing"] = f"{_status} <> '{NORMAL}'"


# Whole numbers; all other sums are of doubles and made from exact parts.
COUNTED = ("anomaly_count",)


class FactMeasures:
    """SQL of aggregates over fact rows."""

    events = "count(1)"

    def flagged(self, name: str) -> str:
        return f"sum(case when {FLAGS[name]} then 1 else 0 end)"

    def total(self, name: str) -> str:
        return f"sum({name})" if name in COUNTED else exact_sum(name)

    def known(self, name: str) -> str:
        return f"count({name})"

    def mean(self, name: str) -> str:
        return guarded_ratio(self.total(name), self.known(name))

    def lowest(self, name: str) -> str:
        return f"min({name})"

    def highest(self, name: str) -> str:
        return f"max({name})"


class RollupMeasures:
    """The same aggregates over rollup rows."""

    events = "coalesce(sum(events), 0)"

    def flagged(self, name: str) -> str:
        return f"sum({name}_events)"

    def total(self, name: str) -> str:
        if name in COUNTED:
            return f"sum({name}_sum)"
        return joined([f"sum({name}_sum{k})" for k in range(LIMBS)])

    def known(self, name: str) -> str:
        return f"sum({name}_known)"

    def mean(self, name: str) -> str:
        return guarded_ratio(self.total(name), self.known(name))

    def lowest(self, name: str) -> str:
        return f"min({name}_min)"

    def highest(self, name: str) -> str:
        return f"max({name}_max)"


def _columns(definitions: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in definitions.items()]


def rollup_fact(fact: DataFrame) -> DataFrame:
    """Mergeable measures per category; partial sums in each task, then a small shuffle."""
    m = FactMeasures()
    measures = {"events": m.events}
    measures |= {f"{flag}_events": m.flagged(flag) for flag in FLAGS}
    for name in (*AVERAGED, *COUNTED):
        measures |= {f"{name}_known": m.known(name)}
        if name in COUNTED:
            measures |= {f"{name}_sum": m.total(name)}
        else:
            measures |= {f"{name}_sum{k}": limb for k, limb in enumerate(limb_sums(name))}
    measures |= {f"{name}_min": m.lowest(name) for name in LOWEST}
    measures |= {f"{name}_max": m.highest(name) for name in HIGHEST}
    return fact.groupBy(*ROLLUP_KEYS).agg(*_columns(measures))


def _measures_of(source: DataFrame) -> FactMeasures | RollupMeasures:
    return RollupMeasures() if "anomaly_count_sum" in source.columns else FactMeasures()


def _means(m, *names: str) -> dict[str, str]:
    return {f"avg_{name}": round_half_up(m.mean(name)) for name in names}


def _mean_anomalies(m) -> str:
    return exact_mean(m.total("anomaly_count"), m.known("anomaly_count"))


def _share(m, flag: str) -> str:
    return share_percent(m.flagged(flag), m.events)


def _health_events(m) -> dict[str, str]:
    return {f"{flag}_events": m.flagged(flag) for flag in ("normal", "warning", "critical")}


def _span(m) -> str:
    return f"({m.highest('odometer_km')} - {m.lowest('odometer_km')})"


def _fuel(m) -> str:
    return m.total("fuel_consumed_this_tick")


def _in_order(name: str, values: tuple[str, ...]) -> Column:
    """Sort key for a fixed order of categories; anything else comes last."""
    listed = ", ".join(f"'{value}'" for value in values)
    return F.expr(f"nullif(array_position(array({listed}), {name}), 0)").asc_nulls_last()


def fct_vehicle_telemetry(silver: DataFrame) -> DataFrame:
    return silver.select(*FACT_COLUMNS)


def dimension(source: DataFrame, name: str) -> DataFrame:
    """Distinct values of one column, NULL included, sorted."""
    return source.select(name).distinct().orderBy(F.asc_nulls_last(name))


def dim_driving_states(source: DataFrame) -> DataFrame:
    return dimension(source, "drive_state")


def dim_gear_group(source: DataFrame) -> DataFrame:
    return dimension(source, "gear_group")


def dim_speed_bucket(source: DataFrame) -> DataFrame:
    return dimension(source, "speed_bucket")


def agg_vehicle_health(source: DataFrame) -> DataFrame:
    """KPIs per overall health, with the share of all events."""
    m = _measures_of(source)
    kpis = {
        "telemetry_events": m.events,
        "anomaly_rate": _share(m, "anomalous"),
        "ready_trip_events": m.flagged("ready"),
        "not_ready_trip_events": m.flagged("not_ready"),
        **_means(m, "speed_kmh", "rpm", "engine_temp"),
        "max_engine_temp": round_half_up(m.highest("engine_temp")),
        **_means(m, "thermal_delta", "oil_pressure", "oil_temp", "battery_voltage", "fuel_level"),
        "total_fuel_consumed": round_half_up(_fuel(m)),
        "avg_tyre_pressure": round_half_up(m.mean("avg_tyre_pressure")),
        "avg_tyre_temperature": round_half_up(m.mean("avg_tyre_temp")),
        "avg_tyre_pressure_imbalance": round_half_up(m.mean("tyre_pressure_imbalance")),
        "avg_tyre_temperature_imbalance": round_half_up(m.mean("tyre_temp_imbalance")),
        "avg_anomaly_count": _mean_anomalies(m),
    }
    grouped = source.groupBy("vehicle_health").agg(*_columns(kpis))
    # One row per health category is left, so the window over all of them is tiny.
    share = share_percent("telemetry_events", "sum(telemetry_events) over ()")
    first, second, *others = grouped.columns
    return grouped.selectExpr(first, second, f"{share} as percentage", *others).orderBy(
        _in_order("vehicle_health", HEALTH_ORDER)
    )


def _inline_rows(rows: list[dict[str, str]]) -> str:
    """SQL that turns one row into several, each with the given columns."""
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in row.items()) + ")" for row in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def unpivot_subsystems(fact: DataFrame) -> DataFrame:
    """One row per event and subsystem: its name and status. One scan, no shuffle."""
    return fact.selectExpr(
        _inline_rows(
            [{"subsystem": f"'{name}'", "status": status} for name, status in SUBSYSTEM_STATUS.items()]
        )
    )


def agg_subsystem_health(source: DataFrame) -> DataFrame:
    """Status frequencies per subsystem.

    Equals grouping ``unpivot_subsystems`` by subsystem. Counting all five at once
    leaves one row to unpivot instead of five copies of every event.
    """
    m = _measures_of(source)
    levels = ("normal", "warning", "critical", "failing")
    counts = {"total_events": m.events}
    for status in SUBSYSTEM_STATUS.values():
        counts |= {f"{status}_{level}": m.flagged(f"{status}_{level}") for level in levels}
    per_subsystem = [
        {"subsystem": f"'{name}'", **{f"{level}_events": f"{status}_{level}" for level in levels}}
        for name, status in SUBSYSTEM_STATUS.items()
    ]
    tall = (
        source.agg(*_columns(counts))
        .where("total_events > 0")
        .selectExpr("total_events", _inline_rows(per_subsystem))
    )
    rates = {
        f"{alias}_rate": share_percent(f"{level}_events", "total_events")
        for alias, level in (("overall_failure", "failing"), ("warning", "warning"), ("critical", "critical"))
    }
    return tall.selectExpr(
        "subsystem",
        "total_events",
        "normal_events",
        "warning_events",
        "critical_events",
        *[f"{sql} as {name}" for name, sql in rates.items()],
        "warning_events + 2 * critical_events as severity_score",
    ).orderBy(
        *[F.desc_nulls_first(c) for c in ("critical_rate", "severity_score", "overall_failure_rate")]
    )


def agg_driving_behavior(source: DataFrame) -> DataFrame:
    """Operating conditions and health per speed category, drive state and engine load."""
    m = _measures_of(source)
    keys = ("speed_bucket", "drive_state", "engine_load")
    kpis = {
        "total_events": m.events,
        **_means(m, "speed_kmh", "rpm", "engine_temp", "thermal_delta", "fuel_level"),
        "total_fuel_consumed": round_half_up(_fuel(m)),
        "avg_anomaly_count": _mean_anomalies(m),
        **_health_events(m),
        "failure_rate": _share(m, "failing"),
        "ready_trip_rate": _share(m, "ready"),
    }
    return (
        source.groupBy(*keys).agg(*_columns(kpis)).orderBy(*[F.asc_nulls_last(key) for key in keys])
    )


def agg_efficiency(source: DataFrame) -> DataFrame:
    """Fuel use and distance per speed category. Distance is the odometer span."""
    m = _measures_of(source)
    kpis = {
        "total_events": m.events,
        "distance_travelled_km": round_half_up(_span(m)),
        "trip_distance_km": round_half_up(m.highest("trip_km")),
        "total_fuel_consumed_l": round_half_up(_fuel(m)),
        "avg_fuel_per_event_l": round_half_up(m.mean("fuel_consumed_this_tick"), 4),
        "km_per_litre": round_half_up(guarded_ratio(_span(m), _fuel(m))),
        "avg_trip_distance_km": round_half_up(m.mean("trip_km")),
        "avg_speed_kmh": round_half_up(m.mean("speed_kmh")),
        "max_speed_kmh": round_half_up(m.highest("speed_kmh")),
        **_means(m, "rpm", "fuel_level"),
        "min_fuel_level": round_half_up(m.lowest("fuel_level")),
        "litres_per_km": round_half_up(guarded_ratio(_fuel(m), _span(m)), 3),
        "avg_throttle": round_half_up(m.mean("throttle")),
        "high_engine_load_percentage": _share(m, "high_load"),
    }
    return (
        source.groupBy("speed_bucket")
        .agg(*_columns(kpis))
        .orderBy(_in_order("speed_bucket", SPEED_ORDER))
    )


def agg_trip_summary(source: DataFrame) -> DataFrame:
    """One row over everything; with no events, zero events and NULL elsewhere."""
    m = _measures_of(source)
    kpis = {
        "total_distance_km": round_half_up(_span(m)),
        "trip_distance_km": round_half_up(m.highest("trip_km")),
        "total_fuel_consumed_l": round_half_up(_fuel(m)),
        "km_per_litre": round_half_up(guarded_ratio(_span(m), _fuel(m))),
        "avg_speed_kmh": round_half_up(m.mean("speed_kmh")),
        "max_speed_kmh": round_half_up(m.highest("speed_kmh")),
        **_means(m, "rpm", "throttle", "engine_temp"),
        "max_engine_temp": round_half_up(m.highest("engine_temp")),
        **_means(m, "oil_temp", "battery_voltage", "fuel_level"),
        "min_fuel_level": round_half_up(m.lowest("fuel_level")),
        "avg_tyre_pressure": round_half_up(m.mean("avg_tyre_pressure")),
        "avg_tyre_temp": round_half_up(m.mean("avg_tyre_temp")),
        "telemetry_events": m.events,
        "avg_anomaly_count": _mean_anomalies(m),
        **_health_events(m),
        "ready_trip_rate": _share(m, "ready"),
    }
    return source.agg(*_columns(kpis))
