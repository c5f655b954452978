"""Session settings and the scratch folder for tables that cut lineage."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; everything else is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A key that comes twice in a message counts by its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles a method above this size; such stages run as smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every column costs several driver calls per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tachoflow", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with the settings above plus the given ones."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sizing_conf(input_bytes: int) -> dict[str, str]:
    """Split and shuffle sizes for a job that reads this many bytes.

    Splits grow from 128 MB to 1 GB so that a 100 TB read needs about 100,000 tasks; a
    shuffle partition takes about 1 GB of raw input. Adaptive execution joins partitions
    that turn out small, it never splits them for an aggregate or a window, so the number
    errs on the high side.
    """
    split = min(1 << 30, max(128 << 20, input_bytes // 100_000))
    partitions = max(200, math.ceil(input_bytes / (1 << 30)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for stream checkpoints and intermediate tables.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. Only a
    local master falls back to the temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return f"{base.rstrip('/')}/tachoflow-{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"tachoflow-{label}-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
