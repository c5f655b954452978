"""Sensor readings derived from the ``events`` table.

Each event gives one reading; every tenth repeats the key of the event before it, some
with an older ingestion time. The text is plain SQL that other engines run as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PAYLOAD_TEXT, TYRE_PRESSURES, TYRE_TEMPS

# {events} stands for the relation (event_id, ts, ...).
SENSOR_SQL = """
with e as (select event_id as e, ts from {events}), k as (select *, e - (case when e % 10 = 9 then 1 else 0 end) as p from e)
select e as id, case when e % 20 = 9 then date_trunc('hour', ts) - interval '1' day else date_trunc('hour', ts) end as ingested_at, date_trunc('hour', ts) as timestamp, cast(p as integer) as tick,
 case when e % 109 = 17 then null else cast((e*53) % 3800 as double) + 900.0 + (case when e % 23 = 3 then 2500.0 else 0.0 end) end as rpm,
 case when e % 101 = 7 then null when e % 5 in (0,4) then 0.0 else cast((e*37) % 1300 as double)/10.0 end as speed_kmh,
 75.0 + cast((e*29) % 280 as double)/10.0 + (case when e % 29 = 5 then 24.0 else 0.0 end) as engine_temp,
 case when e % 113 = 18 then null else 70.0 + cast((e*31) % 250 as double)/10.0 + (case when e % 31 = 6 then 38.0 else 0.0 end) end as oil_temp,
 case when e % 37 = 8 then 0.3 + cast(e % 5 as double)/4.0 else 1.5 + cast((e*13) % 400 as double)/100.0 end as oil_pressure,
 cast((e*7) % 1001 as double)/10.0 as throttle,
 case when e % 41 = 9 then cast(e % 16 as double) else 16.0 + cast((e*11) % 800 as double)/10.0 end as fuel_level,
 0.4 + cast((e*19) % 2000 as double)/100.0 as fuel_flow,
 case when e % 43 = 10 then 9.8 + cast(e % 20 as double)/10.0 else 12.0 + cast((e*23) % 200 as double)/100.0 end as battery_voltage,
 case when e % 5 = 3 then cast((e*17) % 500 as double)/10.0 else 0.0 end as brake_pressure,
 cast(e as double)*0.01 as odometer_km, cast(e % 5000 as double)*0.01 as trip_km,
 case when e % 107 = 16 then null else cast((e*3) % 7 as integer) end as gear,
 true as ignition_on, e % 43 <> 10 as alternator_on, e % 5 = 3 and e % 12 = 0 as abs_active, e % 29 = 5 as check_engine, e % 41 = 9 and e % 16 < 10 as low_fuel_warn,
 case when e % 127 = 19 then null else case e % 5 when 0 then 'IDLE' when 1 then 'ACCELERATING' when 2 then 'CRUISING' when 3 then 'BRAKING' else 'STOPPED' end end as drive_state,
 e % 29 = 5 or e % 37 = 8 or e % 43 = 10 or e % 41 = 9 or e % 47 = 11 as fault_active,
 case when e % 29 = 5 then 'ENGINE_OVERHEAT' when e % 37 = 8 then 'LOW_OIL_PRESSURE' when e % 43 = 10 then 'LOW_BATTERY' when e % 41 = 9 then 'LOW_FUEL' when e % 47 = 11 then 'LOW_TYRE_PRESSURE' else 'NONE' end as fault_type,
 50.0 + cast((e*3) % 80 as double)/10.0 + (case when e % 53 = 13 then 35.0 when e % 59 = 14 then 42.0 else 0.0 end) as tyre_temp_fl,
 50.0 + cast((e*7) % 80 as double)/10.0 + (case when e % 53 = 13 then 35.0 when e % 59 = 14 then 42.0 else 0.0 end) as tyre_temp_fr,
 50.0 + cast((e*11) % 80 as double)/10.0 + (case when e % 53 = 13 then 35.0 when e % 59 = 14 then 42.0 else 0.0 end) as tyre_temp_rl,
 50.0 + cast((e*13) % 80 as double)/10.0 + (case when e % 53 = 13 then 35.0 when e % 59 = 14 then 42.0 when e % 61 = 15 then 9.0 else 0.0 end) as tyre_temp_rr,
 31.0 + cast((e*3) % 20 as double)/10.0 as tyre_pressure_fl, 31.0 + cast((e*7) % 20 as double)/10.0 as tyre_pressure_fr,
 31.0 + cast((e*11) % 20 as double)/10.0 as tyre_pressure_rl,
 case when e % 47 = 11 then 22.0 + cast(e % 8 as double) when e % 103 = 12 then null else 31.0 + cast((e*13) % 20 as double)/10.0 end as tyre_pressure_rr
from k
"""


def sensor_rows(events: DataFrame) -> DataFrame:
    """Typed readings, before de-duplication. Works on streams too."""
    stamped = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return events.sparkSession.sql(SENSOR_SQL, events=stamped)


def sensor_payload(readings: DataFrame) -> DataFrame:
    """The same readings as bronze rows: id, ingestion time and the JSON message."""
    scalars = [F.col(name) for name in PAYLOAD_TEXT]
    wheels = [
        F.array(*TYRE_PRESSURES).alias("tyre_pressure"),
        F.array(*TYRE_TEMPS).alias("tyre_temp"),
    ]
    message = F.to_json(F.struct(*scalars, *wheels))
    return readings.select("id", "ingested_at", message.alias("raw_data"))
