"""SQL that another engine runs on the same tables, one text per registered query."""

from __future__ import annotations

from tachoflow.schema import FACT_COLUMNS, MEASUREMENTS, TYRE_PRESSURES, TYRE_TEMPS
from tachoflow.sources.sensors import SENSOR_SQL

from .catalog import DERIVED, MESSAGE_COLUMNS, READING_COLUMNS, SILVER_ADDED

RELATIONS = f"""
with tel as ({SENSOR_SQL.format(events="events").strip()}),
stg as (
  select * exclude (rn) from (
    select *, row_number() over (partition by timestamp, tick order by ingested_at desc, id desc) as rn
    from tel) where rn = 1),
derived as (
  select *,
    engine_temp*9.0/5.0 + 32.0 as engine_temp_f, oil_temp*9.0/5.0 + 32.0 as oil_temp_f,
    tyre_temp_fl*9.0/5.0 + 32.0 as tyre_temp_fl_f, tyre_temp_fr*9.0/5.0 + 32.0 as tyre_temp_fr_f,
    tyre_temp_rl*9.0/5.0 + 32.0 as tyre_temp_rl_f, tyre_temp_rr*9.0/5.0 + 32.0 as tyre_temp_rr_f,
    fuel_flow/3600.0*0.5 as fuel_consumed_this_tick,
    case when speed_kmh < 30 then 'city' when speed_kmh < 90 then 'suburban' else 'highway' end as speed_bucket,
    speed_kmh is not null and speed_kmh > 0 as is_moving,
    engine_temp - oil_temp as thermal_delta,
    (tyre_pressure_fl + tyre_pressure_fr + tyre_pressure_rl + tyre_pressure_rr)/4.0 as avg_tyre_pressure,
    (tyre_temp_fl + tyre_temp_fr + tyre_temp_rl + tyre_temp_rr)/4.0 as avg_tyre_temp,
    list_max([tyre_pressure_fl, tyre_pressure_fr, tyre_pressure_rl, tyre_pressure_rr])
      - list_min([tyre_pressure_fl, tyre_pressure_fr, tyre_pressure_rl, tyre_pressure_rr]) as tyre_pressure_imbalance,
    list_max([tyre_temp_fl, tyre_temp_fr, tyre_temp_rl, tyre_temp_rr])
      - list_min([tyre_temp_fl, tyre_temp_fr, tyre_temp_rl, tyre_temp_rr]) as tyre_temp_imbalance,
    case when engine_temp - oil_temp < 8 then 'LOW' when engine_temp - oil_temp < 18 then 'NORMAL' else 'HIGH' end as thermal_stress,
    case when rpm < 1500 then 'LOW_LOAD' when rpm < 5000 then 'NORMAL_LOAD' else 'HIGH_LOAD' end as engine_load,
    case when gear = 0 then 'PARKED' when gear <= 2 then 'LOW_GEAR' when gear <= 4 then 'MID_GEAR' else 'HIGH_GEAR' end as gear_group
  from RELATION),
levels as (
  select *,
    case when engine_temp >= 125 or rpm >= 6800 or (engine_temp >= 115 and thermal_stress = 'HIGH') then 2
         when engine_temp >= 105 or engine_load = 'HIGH_LOAD' then 1 else 0 end as engine_level,
    case when oil_pressure <= 1.1 or oil_temp >= 130 then 2 when oil_pressure <= 1.3 or oil_temp >= 115 then 1 else 0 end as oil_level,
    case when battery_voltage <= 10.5 then 2 when battery_voltage <= 11.8 then 1 else 0 end as battery_level,
    case when fuel_level <= 5 then 2 when fuel_level <= 15 then 1 else 0 end as fuel_status_level,
    case when avg_tyre_pressure < 26 or avg_tyre_temp > 90 or tyre_pressure_imbalance > 7 or tyre_temp_imbalance > 15 then 2
         when avg_tyre_pressure < 28 or avg_tyre_temp > 80 or tyre_pressure_imbalance > 4 or tyre_temp_imbalance > 10 then 1
         else 0 end as tyre_level
  from derived),
counted as (
  select *,
    cast(sign(engine_level) + sign(oil_level) + sign(battery_level) + sign(fuel_status_level) + sign(tyre_level) as integer) as anomaly_count,
    greatest(engine_level, oil_level, battery_level, fuel_status_level, tyre_level) as worst
  from levels),
sil as (
  select * exclude (engine_level, oil_level, battery_level, fuel_status_level, tyre_level, worst),
    ['NORMAL', 'WARNING', 'CRITICAL'][engine_level + 1] as engine_status,
    ['NORMAL', 'WARNING', 'CRITICAL'][oil_level + 1] as oil_status,
    ['NORMAL', 'WARNING', 'CRITICAL'][battery_level + 1] as battery_status,
    ['NORMAL', 'WARNING', 'CRITICAL'][fuel_status_level + 1] as fuel_status,
    ['NORMAL', 'WARNING', 'CRITICAL'][tyre_level + 1] as tyre_status,
    case when worst = 2 or anomaly_count > 2 then 'CRITICAL' when worst = 1 then 'WARNING' else 'NORMAL' end as vehicle_health,
    worst = 0 as ready_for_trip
  from counted),
fct as (select {", ".join(FACT_COLUMNS)} from sil)
"""


def _query(text: str, relation: str = "stg") -> str:
    return RELATIONS.replace("RELATION", relation) + text


def _r(expression: str, places: int = 2) -> str:
    return f"cast(round(cast({expression} as decimal(38,10)), {places}) as double)"


def _mean(name: str, alias: str | None = None, places: int = 2) -> str:
    return f"{_r(f'avg({name})', places)} as {alias or 'avg_' + name}"


def _share(condition: str, alias: str) -> str:
    count = f"count(*) filter (where {condition})"
    return f"{_r(f'100.0 * cast({count} as double) / count(*)')} as {alias}"


def _n(condition: str, alias: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint) as {alias}"


HEALTH_EVENTS = ", ".join(
    _n(f"vehicle_health = '{level}'", f"{level.lower()}_events")
    for level in ("NORMAL", "WARNING", "CRITICAL")
)
FUEL = "sum(fuel_consumed_this_tick)"
SPAN = "(max(odometer_km) - min(odometer_km))"
TALL = " union all ".join(
    f"select '{name}' as subsystem, {status} as status from fct"
    for name, status in (
        ("ENGINE", "engine_status"), ("OIL", "oil_status"), ("BATTERY", "battery_status"),
        ("FUEL", "fuel_status"), ("TYRES", "tyre_status"),
    )
)

AGG_VEHICLE_HEALTH = f"""
select vehicle_health, count(*) as telemetry_events,
  {_r("100.0 * cast(count(*) as double) / cast(sum(count(*)) over () as double)")} as percentage,
  {_share("anomaly_count > 0", "anomaly_rate")},
  {_n("ready_for_trip", "ready_trip_events")}, {_n("not ready_for_trip", "not_ready_trip_events")},
  {_mean("speed_kmh")}, {_mean("rpm")}, {_mean("engine_temp")},
  {_r("max(engine_temp)")} as max_engine_temp, {_mean("thermal_delta")},
  {_mean("oil_pressure")}, {_mean("oil_temp")}, {_mean("battery_voltage")}, {_mean("fuel_level")},
  {_r(FUEL)} as total_fuel_consumed,
  {_mean("avg_tyre_pressure", "avg_tyre_pressure")}, {_mean("avg_tyre_temp", "avg_tyre_temperature")},
  {_mean("tyre_pressure_imbalance")}, {_mean("tyre_temp_imbalance", "avg_tyre_temperature_imbalance")},
  {_mean("anomaly_count")}
from fct group by vehicle_health
"""
AGG_SUBSYSTEM_HEALTH = f"""
select subsystem, count(*) as total_events,
  {_n("status = 'NORMAL'", "normal_events")}, {_n("status = 'WARNING'", "warning_events")},
  {_n("status = 'CRITICAL'", "critical_events")},
  {_share("status <> 'NORMAL'", "overall_failure_rate")}, {_share("status = 'WARNING'", "warning_rate")},
  {_share("status = 'CRITICAL'", "critical_rate")},
  cast(sum(case status when 'WARNING' then 1 when 'CRITICAL' then 2 else 0 end) as bigint) as severity_score
from ({TALL}) group by subsystem
"""
AGG_DRIVING_BEHAVIOR = f"""
select speed_bucket, drive_state, engine_load, count(*) as total_events,
  {_mean("speed_kmh")}, {_mean("rpm")}, {_mean("engine_temp")}, {_mean("thermal_delta")},
  {_mean("fuel_level")}, {_r(FUEL)} as total_fuel_consumed, {_mean("anomaly_count")}, {HEALTH_EVENTS},
  {_share("vehicle_health <> 'NORMAL'", "failure_rate")}, {_share("ready_for_trip", "ready_trip_rate")}
from fct group by speed_bucket, drive_state, engine_load
"""
AGG_EFFICIENCY = f"""
select speed_bucket, count(*) as total_events, {_r(SPAN)} as distance_travelled_km,
  {_r("max(trip_km)")} as trip_distance_km, {_r(FUEL)} as total_fuel_consumed_l,
  {_mean("fuel_consumed_this_tick", "avg_fuel_per_event_l", 4)},
  {_r(f"{SPAN} / nullif({FUEL}, 0)")} as km_per_litre, {_mean("trip_km", "avg_trip_distance_km")},
  {_mean("speed_kmh")}, {_r("max(speed_kmh)")} as max_speed_kmh, {_mean("rpm")},
  {_mean("fuel_level")}, {_r("min(fuel_level)")} as min_fuel_level,
  {_r(f"{FUEL} / nullif({SPAN}, 0)", 3)} as litres_per_km, {_mean("throttle")},
  {_share("engine_load = 'HIGH'", "high_engine_load_percentage")}
from fct group by speed_bucket
"""
AGG_TRIP_SUMMARY = f"""
select {_r(SPAN)} as total_distance_km, {_r("max(trip_km)")} as trip_distance_km,
  {_r(FUEL)} as total_fuel_consumed_l, {_r(f"{SPAN} / nullif({FUEL}, 0)")} as km_per_litre,
  {_mean("speed_kmh")}, {_r("max(speed_kmh)")} as max_speed_kmh, {_mean("rpm")}, {_mean("throttle")},
  {_mean("engine_temp")}, {_r("max(engine_temp)")} as max_engine_temp, {_mean("oil_temp")},
  {_mean("battery_voltage")}, {_mean("fuel_level")}, {_r("min(fuel_level)")} as min_fuel_level,
  {_mean("avg_tyre_pressure", "avg_tyre_pressure")}, {_mean("avg_tyre_temp", "avg_tyre_temp")},
  count(*) as telemetry_events, {_mean("anomaly_count")}, {HEALTH_EVENTS},
  {_share("ready_for_trip", "ready_trip_rate")}
from fct
"""
GOLD = {
    "dim_driving_states": "select distinct drive_state from fct",
    "dim_gear_group": "select distinct gear_group from fct",
    "dim_speed_bucket": "select distinct speed_bucket from fct",
    "agg_vehicle_health": AGG_VEHICLE_HEALTH,
    "agg_subsystem_health": AGG_SUBSYSTEM_HEALTH,
    "agg_driving_behavior": AGG_DRIVING_BEHAVIOR,
    "agg_efficiency": AGG_EFFICIENCY,
    "agg_trip_summary": AGG_TRIP_SUMMARY,
}


def _columns(names) -> str:
    return ", ".join(names)


def _with_arrays(relation: str) -> str:
    def text(prefix: str) -> str:
        wheels = ", ".join(f"cast({prefix}_{w} as varchar)" for w in ("fl", "fr", "rl", "rr"))
        return f"concat_ws(',', {wheels}) as {prefix}"

    return (
        f"select {_columns(READING_COLUMNS)}, {text('tyre_pressure')}, {text('tyre_temp')} from {relation}"
    )


REQUIRED = ("timestamp", "tick", "rpm", "speed_kmh", "fuel_level")


def _null_counts(relation: str, names) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as failures from {relation}"
        for c in names
    )


DUPLICATES = "select timestamp, tick, count(*) as occurrences from tel group by timestamp, tick having count(*) > 1"
QUALITY = f"""
select 'staging' as table_name, 'unique_combination' as check_name, 'timestamp,tick' as column_name,
  count(*) as failures from ({DUPLICATES})
union all select 'staging', 'not_null', column_name, failures from ({_null_counts("tel", REQUIRED)})
union all select 'fact', 'not_null', column_name, failures from ({_null_counts("fct", REQUIRED[:2])})
union all select 'fact', 'accepted_values', 'vehicle_health', count(distinct vehicle_health)
  from fct where vehicle_health not in ('NORMAL', 'WARNING', 'CRITICAL')
union all select 'fact', 'accepted_values', 'speed_bucket', count(distinct speed_bucket)
  from fct where speed_bucket not in ('city', 'suburban', 'highway')
"""
STATISTICS = " union all ".join(
    f"select '{s}' as sensor, count({s}) as readings, min({s}) as min_value, max({s}) as max_value, "
    f"{_r(f'avg({s})', 4)} as mean_value, {_r(f'stddev_samp({s})', 4)} as stddev_value from stg"
    for s in (*MEASUREMENTS, *TYRE_PRESSURES, *TYRE_TEMPS)
)
FAULT_CODE = """case when engine_temp > 115 then 'ENGINE_OVERHEAT' when oil_pressure < 0.5 then 'LOW_OIL_PRESSURE'
  when battery_voltage < 10 then 'LOW_BATTERY' when fuel_level < 8 then 'LOW_FUEL'
  when list_min([tyre_pressure_fl, tyre_pressure_fr, tyre_pressure_rl, tyre_pressure_rr]) < 28 then 'LOW_TYRE_PRESSURE'
  else 'NONE' end"""
SEED = """(values ('IDLE', 1, 'Engine is on but the vehicle is stationary', false),
  ('ACCELERATING', 2, 'Vehicle speed is increasing', true),
  ('CRUISING', 3, 'Vehicle is moving at relatively stable speed', true),
  ('BRAKING', 4, 'Vehicle is decelerating', true),
  ('STOPPED', 5, 'Vehicle is fully stopped', false)) as seed(drive_state, drive_state_key, description, is_moving)"""
ALERTS = """
select timestamp, tick, drive_state, speed_kmh, fault_type, engine_status, oil_status, battery_status,
  fuel_status, tyre_status,
  list_min([tyre_pressure_fl, tyre_pressure_fr, tyre_pressure_rl, tyre_pressure_rr]) as min_tyre_pressure,
  list_max([tyre_temp_fl, tyre_temp_fr, tyre_temp_rl, tyre_temp_rr]) as max_tyre_temp,
  anomaly_count, vehicle_health as severity
from sil where fault_active
"""
LIVE = """
select timestamp, tick, speed_kmh, rpm, throttle, brake_pressure,
  tyre_pressure_fl, tyre_pressure_fr, tyre_pressure_rl, tyre_pressure_rr,
  tyre_temp_fl, tyre_temp_fr, tyre_temp_rl, tyre_temp_rr, fault_active, fault_type
from tel
"""
# Records of one load: the later event is the later line.
LAST_LINE = f"""
select {_columns(MESSAGE_COLUMNS)} from (
  select *, row_number() over (partition by timestamp, tick order by id desc) as rn from tel) where rn = 1
"""

# Numbers as JSON shows them, without a fraction of zero.
ONE, TWO = (f"regexp_replace(cast(tyre_pressure_{w} as varchar), '\\.0$', '')" for w in ("fl", "fr"))
DOCUMENTS = f"""
select id, case id % 7 when 1 then '{{"front":' || {ONE} || ',"rear":[' || {TWO} || ']}}' when 2 then {ONE}
    when 3 then '["x",' || {TWO} || ',null,{{"k":[1]}}]' when 4 then '"t' || tick || '"' when 5 then 'null' end as document,
  id % 7 = 5 as is_null, case when id % 7 in (0, 3) then {TWO} end as second, cast(null as varchar) as tenth
from tel
"""
# Builds from readings whose required values are all there; the first from every second one.
VERSIONS = " union all ".join(
    f"select {version} as version, vehicle_health, telemetry_events from (" + _query(
        "select vehicle_health, count(*) as telemetry_events from fct group by vehicle_health",
        "(select * exclude (rn) from (select *, row_number() over (partition by timestamp, tick order by ingested_at desc, id desc) as rn "
        f"from tel where id % 109 <> 17 and id % 101 <> 7 and {condition}) where rn = 1)",
    ) + ")"
    for version, condition in enumerate(("id % 2 = 0", "true"))
)


def all_oracles() -> dict[str, str]:
    messages = f"select {_columns(MESSAGE_COLUMNS)} from tel"
    found = {
        "src_read_jsonl": _query(messages),
        "src_validate_json": _query(
            "select id, form, form in ('recorded', 'repeated_key') as valid from tel, "
            "(values ('recorded'), ('cut'), ('trailing'), ('nan'), ('repeated_key')) as forms(form)"
        ),
        "src_load_bronze": _query(messages),
        "src_last_line_wins": _query(LAST_LINE),
        "src_consume_once": _query(messages),
        "src_consume_late_and_refilled": _query(messages),
        "src_consume_odd_names": _query(messages),
        "src_concurrent_loads": _query("select count(*) as messages, count(*) as ids, count(*) as loaded from tel"),
        "src_invalid_lines": _query(
            "select id % 8 as part, line_number, odometer_km from (select *, row_number() over "
            "(partition by id % 8 order by id) as line_number from tel) where id % 101 = 7"
        ),
        "src_empty_input": _query("select count(*) as loaded, 0 as added from tel"),
        "seed_drive_states": _query(
            "select seed.*, n as events from " + SEED + " left join "
            "(select drive_state, count(*) as n from fct group by drive_state) c using (drive_state)"
        ),
        "stg_parse": _query(_with_arrays("tel")),
        "stg_parse_text": _query(_with_arrays("tel")),
        "stg_dedup": _query(_with_arrays("stg")),
        "stg_sub_documents": _query(DOCUMENTS),
        "silver_enrich": _query(f"select {_columns((*READING_COLUMNS, *SILVER_ADDED))} from sil"),
        "fct_vehicle_telemetry": _query("select * from fct"),
        "share_of_total": _query(
            f"select vehicle_health, telemetry_events, percentage from ({AGG_VEHICLE_HEALTH})"
        ),
        "unpivot_subsystems": _query(TALL),
        "agg_from_messages": _query(AGG_VEHICLE_HEALTH),
        "snk_materialize_table": _query(AGG_DRIVING_BEHAVIOR),
        "snk_lasting_view": _query(f"select {_columns((*READING_COLUMNS, *SILVER_ADDED))} from sil"),
        "snk_published_versions": _query(VERSIONS),
        "snk_layer_routing": _query(
            f"select * from ({AGG_VEHICLE_HEALTH}) join (select vehicle_health, count(*) as silver_events from sil "
            "group by vehicle_health) using (vehicle_health)"
        ),
        "snk_published_fact": _query("select * from fct"),
        "dq_not_null": _query(_null_counts("tel", REQUIRED)),
        "dq_null_rows": _query("select id, timestamp, tick, rpm from tel where rpm is null"),
        "dq_unique_combination": _query(DUPLICATES),
        "dq_accepted_values": _query(
            "select drive_state as value, count(*) as occurrences from fct "
            "where drive_state not in ('IDLE', 'CRUISING', 'STOPPED') group by drive_state"
        ),
        "dq_quality_report": _query(QUALITY, relation="tel"),
        "dq_tick_order": _query(
            "select * from (select timestamp, id, tick, lag(tick) over (order by timestamp, id) "
            "as previous_tick from tel) where tick <= previous_tick"
        ),
        "dq_drive_state_distribution": _query(
            "select drive_state, count(*) as events, "
            + _r("100.0 * cast(count(*) as double) / cast(sum(count(*)) over () as double)")
            + " as percentage from fct group by drive_state"
        ),
        "dq_sensor_statistics": _query(STATISTICS),
        "dq_duplicate_report": _query(DUPLICATES),
        "str_stream_ingest": _query(messages),
        "str_quarantine": _query(
            "select odometer_km, case when id % 7 < 3 then 'rejected' else 'read' end as side from tel"
        ),
        "str_live_tables": _query(
            "select 'telemetry_live' as table_name, throttle as value from tel where id % 7 > 2 "
            "union all select 'stream_alerts', speed_kmh from tel where id % 7 > 2 and fault_active "
            "union all select 'quarantine', odometer_km from tel where id % 7 < 3"
        ),
        "str_replayed_batch": _query(ALERTS, relation="tel"),
        "str_telemetry_live": _query(LIVE),
        "str_active_faults": _query(messages + " where fault_active"),
        "str_stream_alerts": _query(ALERTS, relation="tel"),
        "str_stream_dedup": _query(f"select {_columns(READING_COLUMNS)} from stg"),
        "rul_classify_fault": _query(f"select id, timestamp, tick, {FAULT_CODE} as fault_code from tel"),
        "rul_flags": _query(
            "select id, timestamp, tick, fault_type <> 'NONE' as fault_flag, "
            "fuel_level < 10 as low_fuel_flag, "
            "engine_temp > 112 or oil_pressure < 1.4 as check_engine_flag from tel"
        ),
        "rul_gear_from_speed": _query(
            "select id, timestamp, tick, case when speed_kmh < 1 and drive_state in ('IDLE', 'STOPPED') then 0 "
            "when speed_kmh < 20 then 1 when speed_kmh < 40 then 2 when speed_kmh < 60 then 3 "
            "when speed_kmh < 85 then 4 when speed_kmh < 115 then 5 else 6 end as gear_from_speed from tel"
        ),
    }
    for name, columns in DERIVED.items():
        found[name] = _query(f"select timestamp, tick, {_columns(columns)} from sil")
    for name, text in GOLD.items():
        found[name] = _query(text)
        found[f"rollup_{name}"] = _query(text)
    return found
