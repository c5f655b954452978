"""Load each arriving file into bronze exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.bronze import FILES_PER_LOAD, in_blocks, load_files, new_files


def consume_once(
    spark: SparkSession,
    inbox: str,
    table: str,
    *,
    by_name: bool = False,
    files_per_load: int = FILES_PER_LOAD,
    quarantine: str | None = None,
) -> int:
    """Append the lines of all files not taken before; returns the number of rows.

    The inbox is listed once a run. The table's manifest remembers path, time and size of every
    file taken, so a file that arrives late with an old time is taken, and so is a path that was
    filled again (as a whole: what it repeats is resolved by de-duplication). A crash neither
    repeats nor loses lines. A bad line fails the load before anything is committed, unless a
    ``quarantine`` path takes bad lines. Run one consumer of an inbox at a time.
    """
    blocks = in_blocks(new_files(spark, inbox, table), by_name, files_per_load)
    return sum(load_files(spark, block, table, quarantine=quarantine) for block in blocks)
