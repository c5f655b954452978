"""The live table and the alert table. All operators are stateless and run in batch too."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import enrich
from ..operators.staging import CASTABLE, parse_payload
from ..schema import ALERT_COLUMNS, LIVE_COLUMNS, TYRE_PRESSURES, TYRE_TEMPS
from ..sources.jsonl import is_single_json
from .runs import RunTables, together


def ingest_messages(messages: DataFrame, raw: str = "value") -> DataFrame:
    """JSON messages to typed readings."""
    return parse_payload(messages.select(F.col(raw).alias("raw_data")))


def checked_messages(messages: DataFrame, raw: str = "value") -> DataFrame:
    """Typed readings with the message itself as ``message_text`` and whether it is ``sound``.

    A message is sound if it is one JSON value whose values fit their types. A stream cannot
    stop for a single bad message as a load does: it would meet it again on every restart.
    """
    text = messages.select(F.col(raw).alias("raw_data"), F.col(raw).alias("message_text"))
    parsed = parse_payload(text, lenient=True)
    sound = is_single_json(F.col("message_text")) & F.col(CASTABLE)
    return parsed.withColumn("sound", F.coalesce(sound, F.lit(False))).drop(CASTABLE)


def split_messages(messages: DataFrame, raw: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed readings of the sound messages, and the others as ``raw_data``."""
    checked = checked_messages(messages, raw)
    return sound_readings(checked), rejected_messages(checked)


def sound_readings(checked: DataFrame) -> DataFrame:
    return checked.where("sound").drop("sound", "message_text")


def rejected_messages(checked: DataFrame) -> DataFrame:
    return checked.where("not sound").select(F.col("message_text").alias("raw_data"))


def telemetry_live(readings: DataFrame) -> DataFrame:
    return readings.select(*LIVE_COLUMNS)


def active_faults(readings: DataFrame) -> DataFrame:
    return readings.where("fault_active")


def tyre_summary(readings: DataFrame) -> DataFrame:
    """Lowest tyre pressure and highest tyre temperature in place of four values each."""
    return readings.withColumns(
        {
            "min_tyre_pressure": F.least(*TYRE_PRESSURES),
            "max_tyre_temp": F.greatest(*TYRE_TEMPS),
        }
    )


def stream_alerts(readings: DataFrame) -> DataFrame:
    """Active faults with subsystem health, overall severity and tyre summary."""
    rated = tyre_summary(enrich(active_faults(readings)))
    return rated.withColumn("severity", F.col("vehicle_health")).select(*ALERT_COLUMNS)


#: Tables of the live stream and what each shows of the checked messages.
LIVE_TABLES = {
    "telemetry_live": lambda checked: telemetry_live(sound_readings(checked)),
    "stream_alerts": lambda checked: stream_alerts(sound_readings(checked)),
    "quarantine": rejected_messages,
}

#: Lets adaptive execution size the parts of a table that is kept; read when it is marked to be kept.
SIZED_CACHE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def live_tables(spark: SparkSession, path: str) -> RunTables:
    return RunTables(spark, path, {name: together for name in LIVE_TABLES})


def live_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table of the live stream, as of its last batch."""
    return live_tables(spark, path).read(name)


def add_messages(messages: DataFrame, batch_id: int, path: str, stream: str = "", raw: str = "value") -> None:
    """Add one batch of messages to all live tables; the same batch again changes nothing.

    The batch is read, checked and parsed once and kept for the three writes. Its text is dealt
    out first, by its hash into as many parts of even size as it fills: a batch of few files
    reaches all cores, and a part grows with neither the batch nor the files it came in.
    """
    messages = messages.select(raw).hint("rebalance", raw)
    conf = messages.sparkSession.conf
    before = conf.get(SIZED_CACHE)
    conf.set(SIZED_CACHE, "true")
    try:
        checked = checked_messages(messages, raw).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        conf.set(SIZED_CACHE, before)
    try:
        tables = live_tables(messages.sparkSession, path)
        tables.append({name: show(checked) for name, show in LIVE_TABLES.items()}, batch_id, stream)
        tables.compact()
    finally:
        checked.unpersist()


def live_stream(messages: DataFrame, path: str, checkpoint: str, raw: str = "value", **trigger) -> StreamingQuery:
    """Feed all live tables from one stream of messages; default is to drain the source."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_messages(batch, batch_id, path, checkpoint, raw)

    return (
        messages.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once; default is to drain the source."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
