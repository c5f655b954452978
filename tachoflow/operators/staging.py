"""Staging: typed rows out of the raw payload, latest record per event key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import blank_to_null, to_boolean, to_double, to_doubles, to_int
from ..schema import (
    EVENT_KEY, MEASUREMENTS, MISTYPED, PAYLOAD_DDL, PAYLOAD_TEXT_DDL, STAGING_COLUMNS, SWITCHES,
    TYRE_ARRAYS, WHEELS,
)


# Whether all values of a message fit their declared types.
CASTABLE = "_castable"


def payload_columns(message: str = "message", text: str = "text", cast: str = "cast") -> list[str]:
    """Typed columns of one message, as SQL.

    ``message`` was parsed with its declared types. ``text`` is the same message parsed as
    text; it is present only if some value had another type, and then decides all columns.
    ``cast="try_cast"`` gives NULL where a value does not fit.
    """

    def choose(name: str, declared: str, converted: str) -> str:
        return f"if({message}.{MISTYPED} is null, {declared}, {converted}) as {name}"

    def typed(name: str, convert: Callable[[str, str], str]) -> str:
        return choose(name, f"{message}.{name}", convert(f"{text}.{name}", cast))

    def wheel(array: str, place: int) -> str:
        declared, converted = (f"get({source}.{array}, {place})" for source in (message, text))
        return choose(f"{array}_{WHEELS[place]}", declared, to_double(converted, cast))

    places = range(len(WHEELS))
    return [
        # The event key takes no empty text: it fails under ANSI mode.
        f"{cast}({message}.timestamp as timestamp) as timestamp",
        choose("tick", f"{message}.tick", f"{cast}({text}.tick as int)"),
        *[typed(name, to_double) for name in MEASUREMENTS],
        typed("gear", to_int),
        *[typed(name, to_boolean) for name in SWITCHES],
        f"{message}.drive_state as drive_state",
        typed("fault_active", to_boolean),
        f"{message}.fault_type as fault_type",
        *[choose(name, f"{message}.{name}", to_doubles(f"{text}.{name}")) for name in TYRE_ARRAYS],
        *[wheel("tyre_temp", place) for place in places],
        *[wheel("tyre_pressure", place) for place in places],
    ]


def castable(message: str = "message", text: str = "text") -> str:
    """Whether ``payload_columns`` would cast every value of a message, as SQL."""

    def fits(value: str, converted: str) -> str:
        return f"({value} is null or {converted} is not null)"

    def of_text(value: str, convert: Callable[[str, str], str]) -> str:
        return fits(blank_to_null(value), convert(value, "try_cast"))

    texts = [
        fits(f"{text}.tick", f"try_cast({text}.tick as int)"),
        *[of_text(f"{text}.{name}", to_double) for name in MEASUREMENTS],
        of_text(f"{text}.gear", to_int),
        *[of_text(f"{text}.{name}", to_boolean) for name in (*SWITCHES, "fault_active")],
        *[
            of_text(f"get({text}.{array}, {place})", to_double)
            for array in TYRE_ARRAYS for place in range(len(WHEELS))
        ],
    ]
    stamp = fits(f"{message}.timestamp", f"try_cast({message}.timestamp as timestamp)")
    return f"{stamp} and ({message}.{MISTYPED} is null or ({' and '.join(texts)}))"


def parse_payload(rows: DataFrame, raw: str = "raw_data", *, lenient: bool = False) -> DataFrame:
    """Replace the raw message by its typed columns.

    One JSON parse per row. Only a message with a value of another type, such as a quoted
    number, is parsed again as text and cast value by value. The parsed message comes out
    of a generator: a filter on its columns stays above it, where a filter moved below a
    projection would parse every message once more.

    A value that does not fit its type fails the job under ANSI mode. ``lenient`` makes it
    NULL and adds ``_castable``, which tells whether all values of the message fitted.
    """
    kept = [name for name in rows.columns if name != raw]
    message = F.from_json(raw, PAYLOAD_DDL, {"columnNameOfCorruptRecord": MISTYPED})
    parsed = rows.select(*kept, raw, F.inline(F.array(F.struct(message.alias("message")))))
    reparsed = F.when(F.col("message")[MISTYPED].isNotNull(), F.from_json(raw, PAYLOAD_TEXT_DDL))
    both = parsed.select(*kept, "message", reparsed.alias("text"))
    if lenient:
        return both.selectExpr(*kept, *payload_columns(cast="try_cast"), f"{castable()} as {CASTABLE}")
    return both.selectExpr(*kept, *payload_columns())


def latest_wins(rows: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Keep one row per event key: the latest load, then the highest id.

    Rows without a key form one group and collapse to one row. The rank filter lets
    Spark keep the best row per key inside each task before the shuffle, so a key that
    holds a large part of the table sends at most one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(
        F.desc_nulls_first("ingested_at"), F.desc_nulls_first("id")
    )
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def document_column(name: str) -> str:
    return f"{name}_doc"


def with_documents(rows: DataFrame, names: Sequence[str] = TYRE_ARRAYS, raw: str = "raw_data") -> DataFrame:
    """Add the sub-documents of the message below these keys as they came, as VARIANT columns ``<name>_doc``.

    An array of numbers, a mixed array, an object, a text, a number and a JSON null all stay
    what they are; a missing key gives NULL, as does a message that cannot be read. A key that
    comes twice counts by its last value, given ``spark.sql.variant.allowDuplicateKeys``.
    """
    message = rows.withColumn("_message", F.try_parse_json(raw))
    documents = {document_column(name): F.try_variant_get("_message", f"$.{name}", "variant") for name in names}
    return message.select(*rows.columns, *(value.alias(name) for name, value in documents.items()))


def document_element(document: str, place: int, kind: str = "string") -> Column:
    """Element of an array sub-document (from zero), NULL beyond its end and for anything but an array."""
    return F.try_variant_get(document, f"$[{place}]", kind)


def stage(bronze: DataFrame, *, documents: bool = False) -> DataFrame:
    """Bronze rows to the staging table; with ``documents`` the sub-documents come along, which costs a second parse."""
    if not documents:
        return latest_wins(parse_payload(bronze)).select(*STAGING_COLUMNS)
    staged = latest_wins(parse_payload(with_documents(bronze)))
    return staged.select(*STAGING_COLUMNS, *map(document_column, TYRE_ARRAYS))
