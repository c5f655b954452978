"""Latest-wins de-duplication of a stream.

Batches are de-duplicated and kept side by side as runs with one folder per event date;
``current_rows`` resolves keys that came in several runs. A late record costs one small file
instead of a rewrite of its day. When a level of runs is full, its runs are merged into one, so
a date has a number of folders that grows with the logarithm of the batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import latest_wins
from ..schema import EVENT_KEY
from ..versions import RUNS_PER_LEVEL
from .runs import RunTables

LOG = "log"


def _latest(rows: DataFrame) -> DataFrame:
    """One row per key, in few files per date; a date that holds most rows is split."""
    return latest_wins(rows, ("event_date", *EVENT_KEY)).hint("rebalance", "event_date")


def log_of(spark: SparkSession, path: str, runs_per_level: int = RUNS_PER_LEVEL) -> RunTables:
    return RunTables(spark, path, {LOG: _latest}, ("event_date",), runs_per_level)


def merge_batch(batch: DataFrame, batch_id: int, path: str, stream: str = "", runs_per_level: int = RUNS_PER_LEVEL) -> None:
    """Add one de-duplicated batch; a batch of the same stream and number is added once."""
    dated = batch.withColumns({"event_date": F.to_date("timestamp"), "batch": F.lit(batch_id).cast("long")})
    log = log_of(batch.sparkSession, path, runs_per_level)
    log.append({LOG: _latest(dated)}, batch_id, stream)
    log.compact()


def dedup_stream(readings: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the latest record per event key of a stream with ``id`` and ``ingested_at``."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, checkpoint)

    return (
        readings.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last batch. The event date follows from the key, so a filter
    on ``event_date`` still prunes folders."""
    return latest_wins(log_of(spark, path).read(LOG), ("event_date", *EVENT_KEY)).drop("batch")
