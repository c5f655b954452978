"""Newline-delimited JSON: read, strip, check."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The characters stripped from both ends of a line: all Unicode white space (none lies
# above the first 16 bits).
WHITE_SPACE = "".join(chr(code) for code in range(1 << 16) if chr(code).isspace())
STRICT_JSON = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_bad",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
LINE_DDL = "value STRING, file_path STRING, file_time TIMESTAMP, file_size BIGINT, block_start BIGINT, position BIGINT"
# Low bits of monotonically_increasing_id: the row number inside the task.
ROW_IN_TASK = (1 << 33) - 1


# Start of the message about a line that is not one JSON value.
INVALID = "Invalid JSON"


def escaped(path: str) -> str:
    """A path that stands for itself where Spark expects a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _add_origin(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_lines(spark: SparkSession, path: str | list[str], *, required: bool = False) -> DataFrame:
    """Non-blank lines as ``(value, file_path, file_time, file_size, block_start, position)``.

    A missing path has none, unless it is ``required``: then it is an error, as is a file that
    vanishes before it is read. ``position`` grows with the place of the line in its file. A
    task packs at most one split length of bytes, so its row number stays below the distance
    between two splits of a file, and split start plus row number keeps file order without a
    shuffle.
    """
    reader = spark.read
    if required:
        reader = reader.option("ignoreMissingFiles", False).option("ignoreCorruptFiles", False)
    try:
        text = reader.text(path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINE_DDL)
    return number_lines(_add_origin(text))


def stream_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of all files that arrive in a folder, with their origin; number them per batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _add_origin(reader.load(folder))


def number_lines(lines: DataFrame) -> DataFrame:
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_TASK))
    return (
        lines.select(
            F.btrim("value", F.lit(WHITE_SPACE)).alias("value"),
            "file_path", "file_time", "file_size", "block_start",
            (F.col("block_start") + row).alias("position"),
        )
        .where("value <> ''")
    )


def invalid_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not one JSON value, with their number among the non-blank lines of their file.

    ``lines`` comes from ``read_lines``. A split's lines are numbered by the task that reads
    it; the number of lines in the splits before it is a running sum over one row per split.
    Only bad lines and those rows move, and the text is read twice.
    """
    split = ["file_path", "block_start"]
    # The lines of a split follow each other in their task.
    placed = lines.select(*split, "position", "value", F.monotonically_increasing_id().alias("row"))
    splits = placed.groupBy(*split).agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(*split, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_row")).alias("shift"))
    bad = placed.where(~is_single_json(F.col("value")))
    return bad.join(offsets, split).select(
        "file_path", (F.col("row") + F.col("shift") + 1).alias("line_number"), "position", "value")


def first_invalid_lines(lines: DataFrame) -> DataFrame:
    """The first bad line of every file that has one."""
    return invalid_lines(lines).groupBy("file_path").agg(
        *(F.min_by(c, "line_number").alias(c) for c in ("position", "value")), F.min("line_number").alias("line_number"))


def is_single_json(text: Column) -> Column:
    """Whether the text is exactly one JSON value, in plain built-in expressions.

    Spark's JSON functions ignore what follows the first value. Wrapped in braces and
    again in brackets, trailing text breaks at least one of the two: it cannot close
    both wrappers early. Objects pass the first test, which skips over their content;
    other values are decided by the second.
    """
    braced = F.concat(F.lit('{"v":'), text, F.lit("}"))
    bracketed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    an_object = F.from_json(braced, "v STRUCT<_none: STRING>, _bad STRING", STRICT_JSON)["_bad"].isNull()
    any_value = F.from_json(braced, "v STRING, _bad STRING", STRICT_JSON)["_bad"].isNull()
    return F.coalesce(bracketed & (an_object | any_value), F.lit(False))


def require_json(lines: DataFrame) -> DataFrame:
    """Strict mode: the first bad line fails the job, naming file, position and text.

    The check runs inside the job that writes the lines, so they are read once and a
    failed write commits nothing.
    """
    message = F.concat(
        F.lit(f"{INVALID} in "), F.col("file_path"),
        F.lit(" at position "), F.col("position").cast("string"),
        F.lit(": "), F.col("value"),
    )
    checked = F.when(is_single_json(F.col("value")), F.col("value")).otherwise(F.raise_error(message))
    return lines.withColumn("value", checked)


def split_by_validity(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lenient mode: the good lines, and the lines to put in quarantine."""
    valid = is_single_json(F.col("value"))
    return lines.where(valid), lines.where(~valid)
