"""Data-quality checks. Every check returns its failures as rows, or counts of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.exact import exact_mean_of
from ..functions.numeric import round_half_up, share_percent
from ..functions.ratings import HEALTH_ORDER, SPEED_ORDER
from ..schema import EVENT_KEY, MEASUREMENTS, TYRE_PRESSURES, TYRE_TEMPS

# The published checks.
REQUIRED_IN_STAGING = ("timestamp", "tick", "rpm", "speed_kmh", "fuel_level")
REQUIRED_IN_FACT = ("timestamp", "tick")
ACCEPTED_IN_FACT = {"vehicle_health": HEALTH_ORDER, "speed_bucket": SPEED_ORDER}


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows whose column is NULL."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, failures)`` per column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, and how often."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def duplicate_report(parsed: DataFrame) -> DataFrame:
    """Event keys that were ingested repeatedly."""
    return duplicate_keys(parsed, EVENT_KEY)


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list with their number of rows; NULL is not reported."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def _null_sums(columns: Sequence[str]) -> list:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def _as_rows(totals: DataFrame, checks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """One row per check (table, check, column, SQL of the failures) from one row of totals."""
    rows = [
        f"named_struct('table_name', '{table}', 'check_name', '{check}', 'column_name', '{column}', "
        f"'failures', coalesce({failures}, 0L))"
        for table, check, column, failures in checks
    ]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def quality_report(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """All ten checks as ``(table_name, check_name, column_name, failures)``.

    Two scans: staging is grouped by event key, the fact by its two categories; every check
    of a table comes from those groups.
    """
    keys = staging.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("rows"), *_null_sums(REQUIRED_IN_STAGING))
    of_staging = keys.agg(
        F.count_if(F.col("rows") > 1).alias("repeated"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in REQUIRED_IN_STAGING],
    )
    categories = fact.groupBy(*ACCEPTED_IN_FACT).agg(*_null_sums(REQUIRED_IN_FACT))
    of_fact = categories.agg(
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in REQUIRED_IN_FACT],
        *[
            F.count_distinct(F.when(~F.col(c).isin(*accepted), F.col(c))).alias(f"unexpected_{c}")
            for c, accepted in ACCEPTED_IN_FACT.items()
        ],
    )
    return _as_rows(of_staging, [
        ("staging", "unique_combination", ",".join(EVENT_KEY), "repeated"),
        *[("staging", "not_null", c, f"null_{c}") for c in REQUIRED_IN_STAGING],
    ]).unionByName(_as_rows(of_fact, [
        *[("fact", "not_null", c, f"null_{c}") for c in REQUIRED_IN_FACT],
        *[("fact", "accepted_values", c, f"unexpected_{c}") for c in ACCEPTED_IN_FACT],
    ]))


def tick_order(readings: DataFrame, chunks: int | None = None) -> DataFrame:
    """Readings whose tick does not exceed that of the reading before them.

    Order is (timestamp, id) over the whole table. Range partitioning cuts it into
    chunks of similar size, also inside one timestamp that holds a large part of the
    rows. Each chunk compares its rows with their predecessors; only its first and last
    row (and the violations) go on, and the first rows are compared across chunks.
    """
    chunks = chunks or int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_last("timestamp"), F.asc_nulls_last("id")]
    ranged = (
        readings.select("timestamp", "id", "tick")
        .repartitionByRange(chunks, *order)
        .withColumn("chunk", F.spark_partition_id())
    )
    inside = Window.partitionBy("chunk").orderBy(*order)
    compared = ranged.withColumns(
        {
            "previous_tick": F.lag("tick").over(inside),
            "is_first": F.row_number().over(inside) == 1,
            "is_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    edge = F.col("is_first") | F.col("is_last")
    kept = compared.where(edge | (F.col("tick") <= F.col("previous_tick")))
    # Two edge rows per chunk meet in one group; the violations spread over their ids.
    across = Window.partitionBy(edge, F.when(~edge, F.col("id"))).orderBy(*order)
    joined = kept.withColumn(
        "previous_tick",
        F.when(F.col("is_first"), F.lag("tick").over(across)).otherwise(F.col("previous_tick")),
    )
    return joined.where("tick <= previous_tick").select("timestamp", "id", "tick", "previous_tick")


def drive_state_distribution(fact: DataFrame) -> DataFrame:
    """Events and share of all events per drive state.

    The state is free text, so the total comes from a scalar subquery rather than from a
    window that would gather every state in one task. It sums the same counts, whose
    shuffle Spark reuses.
    """
    counts = fact.groupBy("drive_state").agg(F.count(F.lit(1)).alias("events"))
    total = counts.agg(F.sum("events")).scalar()
    return counts.withColumn("total", total).selectExpr(
        "drive_state", "events", f"{share_percent('events', 'total')} as percentage"
    )


def sensor_statistics(readings: DataFrame, sensors: Sequence[str] | None = None) -> DataFrame:
    """Count, extremes, mean and deviation per sensor, from one pass and one row of totals."""
    sensors = [s for s in (sensors or (*MEASUREMENTS, *TYRE_PRESSURES, *TYRE_TEMPS)) if s in readings.columns]
    measures = {
        "readings": "count({0})",
        "min_value": "min({0})",
        "max_value": "max({0})",
        "mean_value": round_half_up(exact_mean_of("{0}"), 4),
        "stddev_value": round_half_up("stddev_samp({0})", 4),
    }
    totals = readings.agg(
        *[F.expr(sql.format(s)).alias(f"{s}__{m}") for s in sensors for m, sql in measures.items()]
    )
    rows = [
        "named_struct(" + ", ".join([f"'sensor', '{s}'"] + [f"'{m}', {s}__{m}" for m in measures]) + ")"
        for s in sensors
    ]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")
