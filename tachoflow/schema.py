"""Column lists of every layer. Names are lower case throughout."""

from __future__ import annotations

# Payload keys and published column names, in published order.
MEASUREMENTS = (
    "rpm", "speed_kmh", "engine_temp", "oil_temp", "oil_pressure", "throttle",
    "fuel_level", "fuel_flow", "battery_voltage", "brake_pressure", "odometer_km", "trip_km",
)
SWITCHES = ("ignition_on", "alternator_on", "abs_active", "check_engine", "low_fuel_warn")
WHEELS = ("fl", "fr", "rl", "rr")
TYRE_ARRAYS = ("tyre_pressure", "tyre_temp")
TYRE_PRESSURES = tuple(f"tyre_pressure_{w}" for w in WHEELS)
TYRE_TEMPS = tuple(f"tyre_temp_{w}" for w in WHEELS)
PAYLOAD_TEXT = (
    "timestamp", "tick", *MEASUREMENTS, "gear", *SWITCHES,
    "drive_state", "fault_active", "fault_type",
)

# Event key: one reading per timestamp and tick.
EVENT_KEY = ("timestamp", "tick")

STAGING_COLUMNS = (
    "id", "ingested_at", *EVENT_KEY, *MEASUREMENTS, "gear", *SWITCHES,
    "fault_active", "fault_type", "drive_state", *TYRE_ARRAYS, *TYRE_TEMPS, *TYRE_PRESSURES,
)
SUBSYSTEM_STATUS = {
    "ENGINE": "engine_status",
    "OIL": "oil_status",
    "BATTERY": "battery_status",
    "FUEL": "fuel_status",
    "TYRES": "tyre_status",
}
FACT_COLUMNS = (
    "timestamp", "tick", "drive_state", "speed_bucket", "gear", "gear_group", "is_moving",
    "speed_kmh", "rpm", "throttle", "engine_temp", "oil_temp", "oil_pressure",
    "battery_voltage", "fuel_level", "fuel_flow", "trip_km", "odometer_km",
    "avg_tyre_pressure", "avg_tyre_temp", "tyre_pressure_imbalance", "tyre_temp_imbalance",
    "thermal_delta", "thermal_stress", "engine_load", "fuel_consumed_this_tick",
    *SUBSYSTEM_STATUS.values(), "anomaly_count", "vehicle_health", "ready_for_trip",
)
LIVE_COLUMNS = (
    "timestamp", "tick", "speed_kmh", "rpm", "throttle", "brake_pressure",
    *TYRE_PRESSURES, *TYRE_TEMPS, "fault_active", "fault_type",
)
ALERT_COLUMNS = (
    "timestamp", "tick", "drive_state", "speed_kmh", "fault_type",
    *SUBSYSTEM_STATUS.values(), "min_tyre_pressure", "max_tyre_temp", "anomaly_count", "severity",
)

# Column that takes the text of a message with a value of another type than declared.
MISTYPED = "_mistyped"
PAYLOAD_DDL = ", ".join(
    ["timestamp STRING", "tick INT"]
    + [f"{name} DOUBLE" for name in MEASUREMENTS]
    + ["gear INT"]
    + [f"{name} BOOLEAN" for name in (*SWITCHES, "fault_active")]
    + ["drive_state STRING", "fault_type STRING"]
    + [f"{name} ARRAY<DOUBLE>" for name in TYRE_ARRAYS]
    + [f"{MISTYPED} STRING"]
)
# The same message with every scalar as text, so that quoted numbers and empty strings survive.
PAYLOAD_TEXT_DDL = ", ".join(
    [f"{name} STRING" for name in PAYLOAD_TEXT] + [f"{name} ARRAY<STRING>" for name in TYRE_ARRAYS]
)
BRONZE_DDL = "id BIGINT, ingested_at TIMESTAMP, raw_data STRING"
SEED_DDL = "drive_state STRING, drive_state_key INT, description STRING, is_moving BOOLEAN"
