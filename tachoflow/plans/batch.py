"""The batch build: bronze to staging, silver, fact, checks and gold tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from ..operators import gold
from ..operators.quality import quality_report
from ..operators.silver import enrich, silver_sql
from ..operators.staging import stage
from ..schema import EVENT_KEY
from ..sources.seeds import seed_drive_states
from .lake import Lake

SEED, STAGING, SILVER = "drive_state_labels", "stg_events", "int_events_enriched"
FACT, ROLLUP = "fct_vehicle_telemetry", "rollup_events"

# The gold tables do not depend on each other; this many are written at a time.
BUILD_THREADS = 4

GOLD_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dim_driving_states": gold.dim_driving_states,
    "dim_gear_group": gold.dim_gear_group,
    "dim_speed_bucket": gold.dim_speed_bucket,
    "agg_vehicle_health": gold.agg_vehicle_health,
    "agg_subsystem_health": gold.agg_subsystem_health,
    "agg_driving_behavior": gold.agg_driving_behavior,
    "agg_efficiency": gold.agg_efficiency,
    "agg_trip_summary": gold.agg_trip_summary,
}


class QualityError(RuntimeError):
    """Raised with the failed checks when a build may not publish its gold tables."""


def build(
    lake: Lake, bronze: DataFrame, *, strict: bool = True, staging_buckets: int | None = None, documents: bool = False
) -> list:
    """Rebuild every layer from bronze and return the ten check results.

    One shuffle of full rows (the de-duplication), one scan of the fact for all eight gold
    tables. All tables are written beside those in use; only when the checks have passed do
    they replace them, together. ``strict`` stops before that if a check fails, and every old
    table stays readable. ``staging_buckets`` stores staging hashed by event key, which spares
    the uniqueness check its shuffle; ``documents`` keeps the tyre sub-documents in it as they
    came.
    """
    lake.create_schemas()
    try:
        return _build(lake, stage(bronze, documents=documents), strict, (staging_buckets, EVENT_KEY) if staging_buckets else None)
    except BaseException:
        lake.discard()
        raise


def _build(lake: Lake, staged: DataFrame, strict: bool, buckets: tuple | None) -> list:
    lake.write("silver", SEED, seed_drive_states(lake.spark))
    staging = lake.write("silver", STAGING, staged, buckets)
    silver = enrich(staging)
    lake.view("silver", SILVER, silver_sql("{staging}"), {"staging": ("silver", STAGING)})
    fact = lake.write("gold", FACT, gold.fct_vehicle_telemetry(silver))
    rollup = lake.write("gold", ROLLUP, gold.rollup_fact(fact))
    # Ten rows at most.
    report = quality_report(staging, fact).collect()
    failed = [row for row in report if row["failures"]]
    if strict and failed:
        raise QualityError("; ".join(
            f"{r.check_name} on {r.table_name}.{r.column_name}: {r.failures}" for r in failed
        ))
    with ThreadPoolExecutor(BUILD_THREADS) as pool:
        writes = [
            pool.submit(lake.write, "gold", name, build_table(rollup))
            for name, build_table in GOLD_TABLES.items()
        ]
    for write in writes:
        write.result()
    lake.publish()
    lake.read("silver", SILVER).createOrReplaceTempView(SILVER)
    return report
