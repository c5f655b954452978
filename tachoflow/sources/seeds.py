"""The drive-state lookup that ships with the package."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..schema import SEED_DDL

SEED_FILE = Path(__file__).resolve().parent.parent / "data" / "drive_states.csv"


def seed_drive_states(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed rows. A given path is read by Spark, so it must be visible to executors.

    The packaged file exists only where the driver runs; its five rows become a local
    relation.
    """
    if path:
        return spark.read.csv(path, header=True, schema=SEED_DDL)
    with SEED_FILE.open(encoding="utf-8", newline="") as handle:
        rows = [
            (r["drive_state"], int(r["drive_state_key"]), r["description"], r["is_moving"] == "true")
            for r in csv.DictReader(handle)
        ]
    return spark.createDataFrame(rows, SEED_DDL)
