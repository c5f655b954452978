"""Tables, written intermediate results and Arrow steps that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachoflow.session import scratch_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the folder all executors share and read it back.

    Cuts the lineage: a lost executor costs one read, not the work above.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results were written, and executors give unused heap back.

    Spark deletes them once nothing on the driver refers to a step any more, which it notices when
    the driver collects garbage; on a large heap that may be much later than the disks are full. An
    executor keeps the heap that its largest step took, beside the Python workers of the next one,
    until it collects all its garbage. Tasks go to all free cores, so to every executor.
    """
    gc.collect()
    spark._jvm.System.gc()
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, numPartitions=cores).selectExpr("java_method('java.lang.System', 'gc')").collect()


#: Bytes of rows handed to a task's Python worker at once while an operator that asks for it works.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand rows to Python in batches of about BATCH_BYTES, in the jobs that are run meanwhile.

    By count alone a batch of pairs of texts takes some 40 MB, on both sides of each task.
    """
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _give_back() -> None:
    """Return freed memory to the system; Spark keeps a Python worker for the next task, of any step."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Run) -> Run:
    """The step, whose worker keeps no freed memory once a task has ended."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return all_of


def arrow_step(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run a function from one record batch to any number of them over every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return df.mapInArrow(giving_back(run), schema)


#: A side is broadcast only if its counted rows take no more than this.
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a written table for broadcast if its row count proves that it is small."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
