"""The append-only bronze table ``(id, ingested_at, raw_data)``.

A load writes one folder ``load=<unique name>`` with its rows and the file each row came from,
and then a part of the manifest that is made from those rows: one line per file with path,
time and size as the load itself met them, and the ids it gave. What was listed but not read
fails the load. A load counts once the state of the table (``tachoflow.versions``) names its
part of the manifest, so a load that broke off is never seen.

Parts of the manifest are merged level by level. Beside each lies a summary of one line per
folder; a folder whose listing agrees with its summary needs no look at its files.

Ids come from ranges that a load reserves in the same state before it reads, so two loads at
once give distinct ids, and one that starts after another has ended gives greater ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime
from itertools import islice
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..schema import BRONZE_DDL
from ..versions import change_state, new_run, read_state, remove_unused, replace_runs, runs_to_merge
from .jsonl import INVALID, escaped, first_invalid_lines, read_lines, require_json, split_by_validity

FILE_DDL = "file_path STRING, file_time TIMESTAMP, file_size BIGINT"
LOADED_DDL = f"{BRONZE_DDL}, {FILE_DDL}"
MANIFEST_DDL = f"load STRING, folder STRING, {FILE_DDL}, n_rows BIGINT, first_id BIGINT, last_id BIGINT"
SUMMARY_DDL = "folder STRING, files BIGINT, print DECIMAL(38,0)"
FILE_KEY = ("file_path", "file_time", "file_size")
#: A load takes up to so many files; what is left makes further loads.
FILES_PER_LOAD = 20_000
#: Up to so many changed folders are named in the filter on the manifest.
NAMED_FOLDERS = 1_000


class IncompleteLoad(RuntimeError):
    """A load did not read the files that it was to read; nothing of it was committed."""


class InvalidJson(ValueError):
    """A line of a load is not one JSON value; nothing of the load was committed."""


def _runs(spark: SparkSession, table: str) -> list[str]:
    return [run["name"] for run in read_state(spark, table)[1].get("runs", [])]


def _read_runs(spark: SparkSession, table: str, part: str, schema: str) -> DataFrame:
    paths = [f"{table}/_{part}/{name}" for name in _runs(spark, table)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """One row per file of every finished load."""
    return _read_runs(spark, table, "manifest", MANIFEST_DDL)


def scan_bronze(spark: SparkSession, table: str) -> DataFrame:
    """All rows of finished loads; a table that was never written has none."""
    done = manifest(spark, table).select("load").distinct()
    try:
        rows = spark.read.schema(f"{BRONZE_DDL}, load STRING").parquet(table)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], BRONZE_DDL)
    return rows.join(done, "load", "left_semi").select("id", "ingested_at", "raw_data")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder with their time and size; only the listing is read.

    ``path`` is the name as it is, ``file_path`` the same as an encoded URI. Names that begin with a dot or an underscore are not listed, as for all of Spark's sources.
    """
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"folder STRING, path STRING, {FILE_DDL}")
    return files.select(
        F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"),
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def _summary(files: DataFrame) -> DataFrame:
    """Number and fingerprint of the files of each folder. Fingerprints of parts add up."""
    fingerprint = F.sum(F.xxhash64(*FILE_KEY).cast("decimal(20,0)")).cast("decimal(38,0)")
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), fingerprint.alias("print"))


def changed_folders(spark: SparkSession, listed: DataFrame, table: str) -> DataFrame:
    """Folders of a listing whose files are not exactly those of the manifest."""
    known = _read_runs(spark, table, "folders", SUMMARY_DDL).groupBy("folder").agg(
        F.sum("files").alias("known_files"), F.sum("print").alias("known_print"))
    same = (F.col("files") == F.col("known_files")) & (F.col("print") == F.col("known_print"))
    return _summary(listed).join(known, "folder", "left").where(~F.coalesce(same, F.lit(False))).select("folder")


def known_files(spark: SparkSession, table: str, folders: Sequence[str] | None) -> DataFrame:
    """Files of the manifest; only those of some folders, which reaches the Parquet scan, if given."""
    files = manifest(spark, table)
    if folders is not None:
        files = files.where(F.col("folder").isin(list(folders)))
    return files.select(*FILE_KEY)


def new_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Files that no finished load took: unknown paths, and known paths with a new time or size.

    Lists once. Only the manifest of folders with a change is read; an inbox with a folder a
    day costs the summaries of all folders and the files of today's.
    """
    listed = list_files(spark, path)
    changed = changed_folders(spark, listed, table)
    few = [r.folder for r in changed.limit(NAMED_FOLDERS + 1).collect()]
    if not few:
        return listed.limit(0)
    if len(few) > NAMED_FOLDERS:
        return listed.join(known_files(spark, table, None), list(FILE_KEY), "left_anti")
    listed = listed.where(F.col("folder").isin(few))
    return listed.join(known_files(spark, table, few), list(FILE_KEY), "left_anti")


def next_id(spark: SparkSession, table: str) -> int:
    """The first id that no load has reserved."""
    return read_state(spark, table)[1].get("next_id", 0)


def reserve_ids(spark: SparkSession, table: str, number: int) -> int:
    """Reserve so many ids for one load; returns the first of them."""
    state = change_state(spark, table, lambda s: {**s, "next_id": s.get("next_id", 0) + number})
    return state["next_id"] - number


def _split_bytes(spark: SparkSession) -> int:
    text = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return int(text)


def _checked(spark: SparkSession, files: Sequence[Row], ends: dict[str, int], folder: str) -> list[Row]:
    """What the written rows say about each file; raises unless they cover the files listed."""
    # At most FILES_PER_LOAD rows.
    found = spark.read.schema(LOADED_DDL).parquet(folder).groupBy(*FILE_KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).collect()
    for row in found:
        if row.last_id >= ends[row.file_path]:
            raise IncompleteLoad(f"{row.file_path} grew while it was loaded")
    seen = {row.file_path for row in found}
    silent = [f.path for f in files if f.file_path not in seen and f.file_size]
    if silent and not read_lines(spark, [escaped(path) for path in silent], required=True).isEmpty():
        raise IncompleteLoad(f"lines of {silent[0]} or of one of {len(silent)} files were not loaded")
    return found


def _commit(spark: SparkSession, table: str, parts: DataFrame) -> None:
    """Make a part of the manifest count, and merge parts where a level is full."""
    run = {"name": new_run(), "level": 0}
    _write_run(parts, parts.coalesce(1).sortWithinPartitions("folder", "file_path"), table, run["name"])
    change_state(spark, table, lambda s: {**s, "runs": [*s.get("runs", []), run]})
    while full := runs_to_merge(read_state(spark, table)[1]["runs"]):
        merged = {"name": new_run(), "level": full[0]["level"] + 1}
        rows = spark.read.schema(MANIFEST_DDL).parquet(*[f"{table}/_manifest/{r['name']}" for r in full])
        _write_run(rows, rows.sort("folder", "file_path"), table, merged["name"])
        replace_runs(spark, table, full, merged)


def _write_run(rows: DataFrame, ordered: DataFrame, table: str, name: str) -> None:
    """Files in the order of their folders, so that a filter on folders skips most of them, and the summary."""
    ordered.write.parquet(f"{table}/_manifest/{name}")
    _summary(rows).coalesce(1).write.parquet(f"{table}/_folders/{name}")


def remove_old_manifests(spark: SparkSession, table: str, seconds: float = 7 * 86_400) -> int:
    """Delete parts of the manifest that were merged into others so long ago; returns their number."""
    gone = [remove_unused(spark, table, f"{table}/_{part}", seconds) for part in ("manifest", "folders")]
    return len(gone[0])


def load_files(
    spark: SparkSession,
    files: Sequence[Row],
    table: str,
    *,
    ingested_at: datetime | None = None,
    quarantine: str | None = None,
) -> int:
    """Load these files (rows of ``list_files``, in load order) as one load.

    A file's ids start after those of the files before it; it takes no more than its bytes
    plus one split, so ids grow with the bytes loaded. A file that is gone, or was not read for
    any other reason, fails the load; a file that grew meanwhile is met again by the next run.
    Returns the number of rows.
    """
    if not files:
        return 0
    room = _split_bytes(spark) + 1
    at = reserve_ids(spark, table, sum(file.file_size + room for file in files))
    starts, ends = [], {}
    for file in files:
        starts.append((file.file_path, at))
        at += file.file_size + room
        ends[file.file_path] = at
    lines = read_lines(spark, [escaped(file.path) for file in files], required=True)
    load = uuid.uuid4().hex
    if quarantine:
        checked, bad = split_by_validity(lines)
        bad.write.mode("overwrite").parquet(f"{quarantine}/load={load}")
    else:
        checked = require_json(lines)
    # One row per file, so FILES_PER_LOAD at most.
    offsets = F.broadcast(spark.createDataFrame(starts, "file_path STRING, file_start BIGINT"))
    load_time = F.lit(ingested_at) if ingested_at else F.current_timestamp()
    start = F.when(F.col("file_start").isNotNull(), F.col("file_start")).otherwise(
        F.raise_error(F.concat(F.lit("read a file that was not listed: "), F.col("file_path"))).cast("long"))
    rows = checked.join(offsets, "file_path", "left").select(
        (start + F.col("position")).cast("long").alias("id"),
        load_time.cast("timestamp").alias("ingested_at"),
        F.col("value").alias("raw_data"),
        *FILE_KEY,
    )
    folder = f"{table}/load={load}"
    try:
        rows.write.parquet(folder)
    except PySparkException as error:
        if INVALID in str(error):
            raise InvalidJson(_named(lines, files, str(error))) from error
        raise
    found = {row.file_path: row for row in _checked(spark, files, ends, folder)}
    taken = []
    for file in files:
        row = found.get(file.file_path)
        met = (row.file_time, row.file_size, row.n_rows, row.first_id, row.last_id) if row else (
            file.file_time, file.file_size, 0, None, None)
        taken.append((load, file.folder, file.file_path, *met))
    _commit(spark, table, spark.createDataFrame(taken, MANIFEST_DDL))
    return sum(row.n_rows for row in found.values())


def _named(lines: DataFrame, files: Sequence[Row], failure: str) -> str:
    """The first bad line of a failed load, in load order, by its number."""
    # One row per file with a bad line.
    first = {r.file_path: r for r in first_invalid_lines(lines).collect()}
    bad = next((first[f.file_path] for f in files if f.file_path in first), None)
    if bad is None:
        return failure
    return (f"{INVALID} on line {bad.line_number} of {unquote(bad.file_path)}\n"
            f"{INVALID} in {bad.file_path} at position {bad.position}: {bad.value}")


def in_blocks(files: DataFrame, by_name: bool, size: int = FILES_PER_LOAD) -> Iterator[list[Row]]:
    """Files in load order, in blocks for one load each; the order is made once."""
    order = ["file_path"] if by_name else ["file_time", "file_path"]
    rows = files.orderBy(*order).toLocalIterator()
    while block := list(islice(rows, size)):
        yield block


def load_bronze(
    spark: SparkSession,
    source: str,
    table: str,
    *,
    by_name: bool = False,
    ingested_at: datetime | None = None,
    quarantine: str | None = None,
) -> int:
    """Append the lines of a file or folder to bronze, whether or not they were loaded before.

    Files are ordered by modification time, then name; ``by_name`` drops the time, for
    folders whose files were written in parallel. One bad line fails the load, named by its
    number, unless a ``quarantine`` path takes bad lines. A missing or blank source adds
    nothing and writes nothing. Returns the number of new rows.
    """
    if read_lines(spark, source).isEmpty():
        return 0
    blocks = in_blocks(list_files(spark, source), by_name)
    return sum(load_files(spark, block, table, ingested_at=ingested_at, quarantine=quarantine) for block in blocks)
