"""Every registered query: ``(spark, folder of the test tables) -> DataFrame``.

All of them read the whole ``events`` table, from which the sensor readings derive.
Decimals are shown as doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tachoflow.functions import ecu
from tachoflow.operators import gold, quality
from tachoflow.operators.silver import enrich
from tachoflow.operators.staging import document_element, latest_wins, parse_payload, stage, with_documents
from tachoflow.plans.batch import SILVER, QualityError, build
from tachoflow.plans.lake import Lake
from tachoflow.schema import EVENT_KEY, PAYLOAD_TEXT, STAGING_COLUMNS, TYRE_ARRAYS, TYRE_PRESSURES, TYRE_TEMPS
from tachoflow.session import scratch_dir
from tachoflow.sources.bronze import load_bronze, scan_bronze
from tachoflow.sources.jsonl import invalid_lines, is_single_json, read_lines
from tachoflow.sources.seeds import seed_drive_states
from tachoflow.sources.sensors import sensor_payload, sensor_rows
from tachoflow.streaming.dedup import current_rows, dedup_stream
from tachoflow.streaming.ingest import consume_once
from tachoflow.streaming.live import (
    active_faults, add_messages, append_stream, ingest_messages, live_stream, live_table, split_messages,
)

Query = Callable[[SparkSession, str], DataFrame]

READING_COLUMNS = tuple(c for c in STAGING_COLUMNS if c not in TYRE_ARRAYS)
MESSAGE_COLUMNS = tuple(c for c in READING_COLUMNS if c not in ("id", "ingested_at"))

# Query name -> derived columns of the silver layer it shows beside the event key.
DERIVED: dict[str, Sequence[str]] = {
    "prj_unit_convert": (
        "engine_temp_f", "oil_temp_f",
        "tyre_temp_fl_f", "tyre_temp_fr_f", "tyre_temp_rl_f", "tyre_temp_rr_f",
    ),
    "prj_fuel_consumed": ("fuel_consumed_this_tick",),
    "prj_speed_bucket": ("speed_bucket",),
    "prj_is_moving": ("is_moving",),
    "prj_thermal_delta": ("thermal_delta",),
    "prj_avg_tyre_pressure": ("avg_tyre_pressure",),
    "prj_avg_tyre_temp": ("avg_tyre_temp",),
    "prj_tyre_pressure_imbalance": ("tyre_pressure_imbalance",),
    "prj_tyre_temp_imbalance": ("tyre_temp_imbalance",),
    "prj_thermal_stress": ("thermal_stress",),
    "prj_engine_load": ("engine_load",),
    "prj_gear_group": ("gear_group",),
    "prj_engine_status": ("engine_status",),
    "prj_oil_status": ("oil_status",),
    "prj_battery_status": ("battery_status",),
    "prj_fuel_status": ("fuel_status",),
    "prj_tyre_status": ("tyre_status",),
    "prj_anomaly_count": ("anomaly_count",),
    "prj_vehicle_health": ("vehicle_health",),
    "prj_ready_for_trip": ("ready_for_trip",),
}
SILVER_ADDED = tuple(name for names in DERIVED.values() for name in names)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = _events(spark, folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return sensor_rows(_events(spark, folder))


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return sensor_payload(readings(spark, folder))


def staging(spark: SparkSession, folder: str) -> DataFrame:
    return latest_wins(readings(spark, folder))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(staging(spark, folder))


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fct_vehicle_telemetry(silver(spark, folder))


def as_doubles(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField) -> Column:
        column = F.col(f.name)
        return column.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else column

    return df.select(*[shown(f) for f in df.schema.fields])


def _arrays_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.array_join(name, ",") for name in TYRE_ARRAYS})


def _write_messages(df: DataFrame, folder: str) -> None:
    """JSON lines whose file names follow event order."""
    lines = df.repartitionByRange("id").sortWithinPartitions("id")
    sensor_payload(lines).select("raw_data").write.mode("append").text(folder)


# --- sources -------------------------------------------------------------------------


def src_read_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    inbox = scratch_dir(spark, "jsonl")
    _write_messages(readings(spark, folder), inbox)
    lines = read_lines(spark, inbox)
    return ingest_messages(lines).select(*MESSAGE_COLUMNS)


def src_validate_json(spark: SparkSession, folder: str) -> DataFrame:
    """Every message as recorded, and cut, followed by text, with a NaN, with a key twice."""
    message = F.col("raw_data")
    opened = F.expr("left(raw_data, length(raw_data) - 1)")
    forms = {
        "recorded": message,
        "cut": opened,
        "trailing": F.concat(message, F.lit(" junk")),
        "nan": F.concat(opened, F.lit(',"x":NaN}')),
        "repeated_key": F.concat(opened, F.lit(',"tick":1}')),
    }
    lines = F.array(
        *[F.struct(F.lit(name).alias("form"), line.alias("line")) for name, line in forms.items()]
    )
    return (
        bronze(spark, folder)
        .select("id", F.inline(lines))
        .select("id", "form", is_single_json(F.col("line")).alias("valid"))
    )


def src_load_bronze(spark: SparkSession, folder: str) -> DataFrame:
    inbox, table = scratch_dir(spark, "load-in"), scratch_dir(spark, "load-out")
    _write_messages(readings(spark, folder), inbox)
    load_bronze(spark, inbox, table, by_name=True)
    return parse_payload(scan_bronze(spark, table)).select(*MESSAGE_COLUMNS)


def src_last_line_wins(spark: SparkSession, folder: str) -> DataFrame:
    """One load, so only the order of lines decides between records of one key."""
    inbox, table = scratch_dir(spark, "order-in"), scratch_dir(spark, "order-out")
    _write_messages(readings(spark, folder), inbox)
    load_bronze(spark, inbox, table, by_name=True)
    return stage(scan_bronze(spark, table)).select(*MESSAGE_COLUMNS)


def src_consume_once(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty readings arrive first, the others later; each run takes what is new."""
    inbox, table = scratch_dir(spark, "once-in"), scratch_dir(spark, "once-out")
    rows = readings(spark, folder)
    for part in ("fault_active", "not fault_active"):
        _write_messages(rows.where(part), inbox)
        consume_once(spark, inbox, table)
    consume_once(spark, inbox, table)
    return parse_payload(scan_bronze(spark, table)).select(*MESSAGE_COLUMNS)


def _age(spark: SparkSession, folder: str, days: int) -> None:
    """Set the modification time of a folder's files back."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def src_consume_late_and_refilled(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries: one, one whose files are a month older, one below the paths of the first."""
    inbox, table = scratch_dir(spark, "late-in"), scratch_dir(spark, "late-out")
    rows = readings(spark, folder)
    for turn, part in enumerate(("id % 3 = 0", "id % 3 = 1", "id % 3 = 2")):
        target = f"{inbox}/part={1 if turn == 1 else 0}"
        sensor_payload(rows.where(part)).select("raw_data").coalesce(1).write.mode("overwrite").text(target)
        if turn == 2:
            _rename_as_before(spark, target, names)
        if turn == 1:
            _age(spark, target, 30)
        if turn == 0:
            names = _file_names(spark, target)
        consume_once(spark, f"{inbox}/*", table)
    return parse_payload(scan_bronze(spark, table)).select(*MESSAGE_COLUMNS)


def _file_names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.getPath().getName().startswith("part-"))


def _rename_as_before(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Give the files of a folder the names that its files had in an earlier delivery."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for now, before in zip(_file_names(spark, folder), names):
        files.rename(hadoop.Path(f"{folder}/{now}"), hadoop.Path(f"{folder}/{before}"))


#: Names that need care: blank, brackets, percent, hash, question mark, braces, star, plus, accent.
ODD_NAMES = ("a b.jsonl", "p[1].jsonl", "x%y.jsonl", "h#1.jsonl", "q?z.jsonl", "b{1,2}.jsonl", "s*r.jsonl", "n+1.jsonl", "é%20.jsonl")


def src_consume_odd_names(spark: SparkSession, folder: str) -> DataFrame:
    """One file of every odd name, delivered in two goes."""
    inbox, table = scratch_dir(spark, "odd-in"), scratch_dir(spark, "odd-out")
    rows = sensor_payload(readings(spark, folder))
    half = len(ODD_NAMES) // 2
    for turn, names in enumerate((ODD_NAMES[:half], ODD_NAMES[half:])):
        target = f"{inbox}/part={turn}"
        own = rows.where(F.col("id") % 2 == turn).repartition(len(names), (F.col("id") / 2).cast("long"))
        own.select("raw_data").write.text(target)
        _rename_as_before(spark, target, names)
        consume_once(spark, f"{inbox}/*", table)
    return parse_payload(scan_bronze(spark, table)).select(*MESSAGE_COLUMNS)


def src_concurrent_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Four loads at once into one table: every message once, every id once."""
    table, rows = scratch_dir(spark, "meet-out"), readings(spark, folder)
    inboxes = [scratch_dir(spark, f"meet-in-{turn}") for turn in range(4)]
    for turn, inbox in enumerate(inboxes):
        _write_messages(rows.where(F.col("id") % 4 == turn), inbox)
    with ThreadPoolExecutor(4) as pool:
        loaded = sum(pool.map(lambda inbox: load_bronze(spark, inbox, table, by_name=True), inboxes))
    return scan_bronze(spark, table).agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("id").alias("ids"), F.lit(loaded).cast("long").alias("loaded"))


def _parted_messages(events: DataFrame) -> DataFrame:
    """Lines (part, line) of eight files in order of id. Events are dealt and sorted before their messages are made, so a task sorts short rows."""
    part = F.col("event_id") % 8
    placed = events.select("event_id", "ts").repartitionByRange(8, part).sortWithinPartitions(part, "event_id")
    rows = sensor_payload(sensor_rows(placed)).where("raw_data is not null")
    cut = F.when(F.col("id") % 101 == 7, F.expr("left(raw_data, length(raw_data) - 1)")).otherwise(F.col("raw_data"))
    blank = F.array_repeat(F.lit("  "), (F.col("id") % 3).cast("int"))
    return rows.select((F.col("id") % 8).alias("part"), F.array_join(F.array_append(blank, cut), "\n").alias("line"))


def src_invalid_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Eight files with blank lines in between; of every 101 messages one is cut. Each bad line by its number."""
    inbox = scratch_dir(spark, "numbered")
    _parted_messages(_events(spark, folder)).write.partitionBy("part").text(inbox)
    found = invalid_lines(read_lines(spark, f"{inbox}/*"))
    part = F.regexp_extract("file_path", "part=([0-9]+)", 1).cast("long")
    distance = F.regexp_extract("value", '"odometer_km":([-+.0-9E]+)', 1).cast("double")
    return found.select(part.alias("part"), "line_number", distance.alias("odometer_km"))


def src_empty_input(spark: SparkSession, folder: str) -> DataFrame:
    """A load of nothing adds nothing to a loaded table."""
    inbox, table = scratch_dir(spark, "empty-in"), scratch_dir(spark, "empty-out")
    _write_messages(readings(spark, folder), inbox)
    consume_once(spark, inbox, table)
    added = load_bronze(spark, f"{inbox}/none", table)
    return scan_bronze(spark, table).agg(F.count(F.lit(1)).alias("loaded"), F.lit(added).cast("long").alias("added"))


def seed_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The seed rows with the number of fact rows in each state."""
    counts = fact(spark, folder).groupBy("drive_state").agg(F.count(F.lit(1)).alias("events"))
    return seed_drive_states(spark).join(counts, "drive_state", "left")


# --- staging -------------------------------------------------------------------------


def stg_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _arrays_as_text(parse_payload(bronze(spark, folder)))


def stg_parse_text(spark: SparkSession, folder: str) -> DataFrame:
    """Messages whose values are all quoted, a missing one being blank, among typed ones."""
    rows = readings(spark, folder)
    scalars = [
        F.col(c) if c in ("timestamp", "drive_state", "fault_type")
        else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        for c in PAYLOAD_TEXT
    ]
    wheels = [
        F.array(*[F.col(c).cast("string") for c in names]).alias(array)
        for array, names in (("tyre_pressure", TYRE_PRESSURES), ("tyre_temp", TYRE_TEMPS))
    ]
    quoted = rows.where("id % 2 = 1").select(
        "id", "ingested_at", F.to_json(F.struct(*scalars, *wheels)).alias("raw_data"))
    return _arrays_as_text(parse_payload(sensor_payload(rows.where("id % 2 = 0")).union(quoted)))


def stg_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _arrays_as_text(stage(bronze(spark, folder)))


def stg_sub_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Messages whose tyre pressures are an array, an object, a number, a mixed array, a text, null or not there."""
    form, one, two = F.col("id") % 7, F.col("tyre_pressure_fl"), F.col("tyre_pressure_fr")
    text = F.concat(F.lit("t"), F.col("tick"))
    forms = {
        1: F.to_json(F.struct(F.struct(one.alias("front"), F.array(two).alias("rear")).alias("v"))),
        2: F.to_json(F.struct(one.alias("v"))),
        3: F.concat(F.lit('{"v":["x",'), two.cast("string"), F.lit(',null,{"k":[1]}]}')),
        4: F.to_json(F.struct(text.alias("v"))),
        5: F.lit('{"v":null}'),
    }
    rows = readings(spark, folder)
    sent = F.col("raw_data")
    for k, document in forms.items():
        value = F.regexp_extract(document, r'^\{"v":(.*)\}$', 1)
        changed = F.regexp_replace(F.col("raw_data"), F.lit(r'"tyre_pressure":\[[^\]]*\]'), F.concat(F.lit('"tyre_pressure":'), value))
        sent = F.when(form == k, changed).otherwise(sent)
    sent = F.when(form == 6, F.regexp_replace("raw_data", r',"tyre_pressure":\[[^\]]*\]', "")).otherwise(sent)
    messages = sensor_payload(rows).join(rows.select("id", "tick", *TYRE_PRESSURES), "id").withColumn("raw_data", sent)
    # The fourth wheel is missing in some readings, so whole arrays are compared by their first two elements.
    found = with_documents(messages.select("id", "raw_data"), ["tyre_pressure"])
    document = F.col("tyre_pressure_doc")
    return found.select(
        "id", F.when(F.col("id") % 7 != 0, F.to_json(document)).alias("document"), F.is_variant_null(document).alias("is_null"),
        document_element("tyre_pressure_doc", 1).alias("second"), document_element("tyre_pressure_doc", 9).alias("tenth"))


# --- silver --------------------------------------------------------------------------


def _derived(names: Sequence[str]) -> Query:
    return lambda spark, folder: silver(spark, folder).select(*EVENT_KEY, *names)


def silver_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder).select(*READING_COLUMNS, *SILVER_ADDED)


# --- gold ----------------------------------------------------------------------------


def _of_fact(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: as_doubles(operator(fact(spark, folder)))


def _of_rollup(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: as_doubles(operator(gold.rollup_fact(fact(spark, folder))))


def agg_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way: messages, parse, latest wins, silver, fact, aggregate."""
    facts = gold.fct_vehicle_telemetry(enrich(stage(bronze(spark, folder))))
    return as_doubles(gold.agg_vehicle_health(facts))


def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    shares = gold.agg_vehicle_health(fact(spark, folder))
    return as_doubles(shares.select("vehicle_health", "telemetry_events", "percentage"))


def _published(table: str) -> Query:
    """Build every layer as tables in a scratch lake and read one gold table back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lake = Lake(spark, root=scratch_dir(spark, "lake"))
        build(lake, bronze(spark, folder), strict=False)
        return as_doubles(lake.read("gold", table))

    return run


def snk_lasting_view(spark: SparkSession, folder: str) -> DataFrame:
    """The silver view of a published lake, read by a session that did not build it."""
    root = scratch_dir(spark, "view-lake")
    build(Lake(spark, root=root), bronze(spark, folder), strict=False)
    shown = Lake(spark.newSession(), root=root).read("silver", SILVER)
    return shown.select(*READING_COLUMNS, *SILVER_ADDED)


def snk_published_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A good build, one that fails its checks, and a second good one: what each version shows."""
    lake, rows = Lake(spark, root=scratch_dir(spark, "versions")), bronze(spark, folder)
    sound = rows.where("id % 109 <> 17 and id % 101 <> 7")
    build(lake, sound.where("id % 2 = 0"))
    try:
        build(lake, rows)
        raise AssertionError("readings without a value passed the checks")
    except QualityError:
        pass
    build(lake, sound)
    return as_doubles(reduce(DataFrame.unionByName, [
        lake.read("gold", "agg_vehicle_health", version).withColumn("version", F.lit(turn))
        for turn, version in enumerate(lake.versions())
    ]).select("version", "vehicle_health", "telemetry_events"))


def snk_layer_routing(spark: SparkSession, folder: str) -> DataFrame:
    """Build into schemas of the catalog, one of them renamed, and read its tables by name."""
    mark = uuid.uuid4().hex[:8]
    names = {"bronze": f"raw_{mark}", "silver": f"clean_{mark}", "gold": f" marts_{mark} "}
    build(Lake(spark, schemas=names), bronze(spark, folder), strict=False)
    events = spark.table(f"clean_{mark}.int_events_enriched").groupBy("vehicle_health").agg(F.count(F.lit(1)).alias("silver_events"))
    return as_doubles(spark.table(f"marts_{mark}.agg_vehicle_health").join(events, "vehicle_health"))


# --- quality -------------------------------------------------------------------------


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_counts(readings(spark, folder), quality.REQUIRED_IN_STAGING)


def dq_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_rows(readings(spark, folder), "rpm").select("id", *EVENT_KEY, "rpm")


def dq_unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(readings(spark, folder), EVENT_KEY)


def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    """Drive states outside a list that leaves two of them out."""
    return quality.unexpected_values(
        fact(spark, folder), "drive_state", ("IDLE", "CRUISING", "STOPPED")
    )


def dq_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """On rows before de-duplication, so that checks find failures."""
    rows = readings(spark, folder)
    return quality.quality_report(rows, gold.fct_vehicle_telemetry(enrich(rows)))


def dq_tick_order(spark: SparkSession, folder: str) -> DataFrame:
    return quality.tick_order(readings(spark, folder))


def dq_drive_state_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(quality.drive_state_distribution(fact(spark, folder)))


def dq_sensor_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return as_doubles(quality.sensor_statistics(staging(spark, folder)))


def dq_duplicate_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_report(parse_payload(bronze(spark, folder)))


# --- streaming -----------------------------------------------------------------------


def _drained(operator: Callable[[DataFrame], DataFrame], label: str) -> Query:
    """Run an operator on a stream of JSON messages into a table, then read the table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        messages = sensor_payload(sensor_rows(_event_stream(spark, folder)))
        target = scratch_dir(spark, label)
        result = operator(ingest_messages(messages, raw="raw_data"))
        append_stream(result, target, scratch_dir(spark, f"{label}-checkpoint")).awaitTermination()
        return spark.read.schema(result.schema).parquet(target)

    return run


def _live(folder_messages: DataFrame, spark: SparkSession, label: str) -> str:
    """Run the live stream over messages (``raw_data``); returns the folder of its tables."""
    target = scratch_dir(spark, label)
    live_stream(folder_messages, target, scratch_dir(spark, f"{label}-checkpoint"), raw="raw_data").awaitTermination()
    return target


def _of_live(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        messages = sensor_payload(sensor_rows(_event_stream(spark, folder))).select("raw_data")
        return live_table(spark, _live(messages, spark, table), table)

    return run


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Of every seven messages one is cut, one has text behind it, one a tick that does not fit."""
    form, message = F.col("id") % 7, F.col("raw_data")
    rows = sensor_payload(sensor_rows(_event_stream(spark, folder)))
    sent = (
        F.when(form == 0, F.expr("left(raw_data, length(raw_data) - 1)"))
        .when(form == 1, F.concat(message, F.lit(" junk")))
        .when(form == 2, F.regexp_replace(message, '"tick":[0-9]+', '"tick":"3.0"'))
        .otherwise(message)
    )
    return rows.select(sent.alias("raw_data"))


def str_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    read, rejected = split_messages(_damaged(spark, folder), raw="raw_data")
    distance = F.regexp_extract("raw_data", '"odometer_km":([-+.0-9E]+)', 1).cast("double")
    sides = {
        "read": read.select("odometer_km"),
        "rejected": rejected.select(distance.alias("odometer_km")),
    }
    found = []
    for side, stream in sides.items():
        target = scratch_dir(spark, side)
        append_stream(stream, target, scratch_dir(spark, f"{side}-checkpoint")).awaitTermination()
        found.append(spark.read.schema(stream.schema).parquet(target).withColumn("side", F.lit(side)))
    return found[0].unionByName(found[1])


def str_live_tables(spark: SparkSession, folder: str) -> DataFrame:
    """One query over damaged messages feeds three tables; what each of them holds."""
    target = _live(_damaged(spark, folder), spark, "live-tables")
    distance = F.regexp_extract("raw_data", '"odometer_km":([-+.0-9E]+)', 1).cast("double")
    shown = {"telemetry_live": F.col("throttle"), "stream_alerts": F.col("speed_kmh"), "quarantine": distance}
    parts = [live_table(spark, target, name).select(F.lit(name).alias("table_name"), value.alias("value")) for name, value in shown.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def str_replayed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that come again change no table, before and after their runs were merged."""
    target = scratch_dir(spark, "replay")
    messages = bronze(spark, folder)
    for number in (*range(9), 0, 4, 8):
        add_messages(messages.where(F.col("id") % 9 == number), number, target, raw="raw_data")
    return live_table(spark, target, "stream_alerts")


def str_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    target, checkpoint = scratch_dir(spark, "log"), scratch_dir(spark, "log-checkpoint")
    rows = sensor_rows(_event_stream(spark, folder))
    dedup_stream(rows, target, checkpoint).awaitTermination()
    return current_rows(spark, target).select(*READING_COLUMNS)


# --- recomputed flags ----------------------------------------------------------------


def rul_classify_fault(spark: SparkSession, folder: str) -> DataFrame:
    code = ecu.classify_fault(
        F.col("engine_temp"), F.col("oil_pressure"), F.col("battery_voltage"), F.col("fuel_level"),
        [F.col(c) for c in TYRE_PRESSURES],
    )
    return readings(spark, folder).select("id", *EVENT_KEY, code.alias("fault_code"))


def rul_flags(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).select(
        "id",
        *EVENT_KEY,
        ecu.fault_flag(F.col("fault_type")).alias("fault_flag"),
        ecu.low_fuel_flag(F.col("fuel_level")).alias("low_fuel_flag"),
        ecu.check_engine_flag(F.col("engine_temp"), F.col("oil_pressure")).alias("check_engine_flag"),
    )


def rul_gear_from_speed(spark: SparkSession, folder: str) -> DataFrame:
    gear = ecu.gear_from_speed(F.col("speed_kmh"), F.col("drive_state"))
    return readings(spark, folder).select("id", *EVENT_KEY, gear.alias("gear_from_speed"))


def all_queries() -> dict[str, Query]:
    from tachoflow.plans.batch import GOLD_TABLES

    found: dict[str, Query] = {
        "src_read_jsonl": src_read_jsonl,
        "src_validate_json": src_validate_json,
        "src_load_bronze": src_load_bronze,
        "src_last_line_wins": src_last_line_wins,
        "src_consume_once": src_consume_once,
        "src_consume_late_and_refilled": src_consume_late_and_refilled,
        "src_consume_odd_names": src_consume_odd_names,
        "src_concurrent_loads": src_concurrent_loads,
        "src_invalid_lines": src_invalid_lines,
        "src_empty_input": src_empty_input,
        "seed_drive_states": seed_labels,
        "stg_parse": stg_parse,
        "stg_parse_text": stg_parse_text,
        "stg_dedup": stg_dedup,
        "stg_sub_documents": stg_sub_documents,
    }
    found.update({name: _derived(columns) for name, columns in DERIVED.items()})
    found.update(
        silver_enrich=silver_enrich,
        fct_vehicle_telemetry=fact,
        share_of_total=share_of_total,
        unpivot_subsystems=_of_fact(gold.unpivot_subsystems),
        agg_from_messages=agg_from_messages,
    )
    found.update({name: _of_fact(operator) for name, operator in GOLD_TABLES.items()})
    found.update({f"rollup_{name}": _of_rollup(operator) for name, operator in GOLD_TABLES.items()})
    found["snk_materialize_table"] = _published("agg_driving_behavior")
    found["snk_lasting_view"] = snk_lasting_view
    found["snk_published_versions"] = snk_published_versions
    found["snk_layer_routing"] = snk_layer_routing
    found["snk_published_fact"] = _published("fct_vehicle_telemetry")
    found.update(
        dq_not_null=dq_not_null,
        dq_null_rows=dq_null_rows,
        dq_unique_combination=dq_unique_combination,
        dq_accepted_values=dq_accepted_values,
        dq_quality_report=dq_quality_report,
        dq_tick_order=dq_tick_order,
        dq_drive_state_distribution=dq_drive_state_distribution,
        dq_sensor_statistics=dq_sensor_statistics,
        dq_duplicate_report=dq_duplicate_report,
        str_stream_ingest=_drained(lambda df: df.select(*MESSAGE_COLUMNS), "ingest"),
        str_telemetry_live=_of_live("telemetry_live"),
        str_active_faults=_drained(
            lambda df: active_faults(df).select(*MESSAGE_COLUMNS), "faults"
        ),
        str_stream_alerts=_of_live("stream_alerts"),
        str_quarantine=str_quarantine,
        str_live_tables=str_live_tables,
        str_replayed_batch=str_replayed_batch,
        str_stream_dedup=str_stream_dedup,
        rul_classify_fault=rul_classify_fault,
        rul_flags=rul_flags,
        rul_gear_from_speed=rul_gear_from_speed,
    )
    return found
