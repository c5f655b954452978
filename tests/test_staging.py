import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tachoflow.operators.staging import document_element, latest_wins, parse_payload, stage, with_documents
from tachoflow.schema import STAGING_COLUMNS

TIME = "2024-05-01T10:00:00.123456+00:00"


def _bronze(spark, *messages):
    rows = [(i, datetime(2024, 5, 1), m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "id BIGINT, ingested_at TIMESTAMP, raw_data STRING")


def _parsed(spark, message):
    return parse_payload(_bronze(spark, message)).first()


def test_full_message(spark):
    message = {
        "timestamp": TIME, "tick": 7, "rpm": 812.5, "gear": 2, "ignition_on": True,
        "fault_active": False, "fault_type": "NONE", "drive_state": "IDLE",
        "tyre_pressure": [31.1, 32, 33.25, 34], "tyre_temp": [50, 51, 52, 53.5], "unknown": [1],
    }
    staged = stage(_bronze(spark, message))
    assert tuple(staged.columns) == STAGING_COLUMNS
    row = staged.first()
    assert row.timestamp == datetime(2024, 5, 1, 10, 0, 0, 123456)
    assert (row.tick, row.rpm, row.gear, row.ignition_on, row.fault_active) == (7, 812.5, 2, True, False)
    assert (row.tyre_pressure_fl, row.tyre_pressure_rr, row.tyre_temp_rr) == (31.1, 34.0, 53.5)
    assert row.tyre_pressure == [31.1, 32.0, 33.25, 34.0]
    assert row.speed_kmh is None


@pytest.mark.parametrize(
    "text, expected",
    [('"12.5"', 12.5), ('""', None), ("null", None), ("12.5", 12.5), ("12", 12.0), ("1.25e1", 12.5)],
)
def test_numbers(spark, text, expected):
    assert _parsed(spark, f'{{"tick":1,"rpm":{text}}}').rpm == expected


@pytest.mark.parametrize(
    "text, expected",
    [("true", True), ('"true"', True), ('"ON"', True), ('"tru"', True), ('"off"', False), ('"n"', False),
     ('""', None), ("null", None), ('"0"', False)],
)
def test_switches(spark, text, expected):
    assert _parsed(spark, f'{{"ignition_on":{text}}}').ignition_on is expected


def test_repeated_key_takes_the_last(spark):
    assert _parsed(spark, '{"rpm":1,"rpm":2}').rpm == 2.0
    assert _parsed(spark, '{"rpm":"x","rpm":"2"}').rpm == 2.0
    assert _parsed(spark, '{"rpm":1,"rpm":"2"}').rpm == 2.0


def test_one_quoted_value_does_not_disturb_the_others(spark):
    row = _parsed(spark, '{"tick":3,"rpm":"1.5","speed_kmh":2.5,"abs_active":true,"tyre_temp":[50,"51"]}')
    assert (row.tick, row.rpm, row.speed_kmh, row.abs_active) == (3, 1.5, 2.5, True)
    assert (row.tyre_temp_fl, row.tyre_temp_fr, row.tyre_temp_rl) == (50.0, 51.0, None)
    assert row.tyre_temp == [50.0, 51.0]


def test_short_or_wrong_tyres(spark):
    row = _parsed(spark, '{"tick":1,"tyre_temp":[50],"tyre_pressure":"x"}')
    assert (row.tick, row.tyre_temp_fl, row.tyre_temp_fr) == (1, 50.0, None)
    assert row.tyre_pressure is None and row.tyre_pressure_fl is None


@pytest.mark.parametrize("line", ["[1]", "5", "null", '"x"'])
def test_non_objects_give_an_empty_row(spark, line):
    row = _parsed(spark, line)
    assert row.id == 0 and all(v is None for k, v in row.asDict().items() if k not in ("id", "ingested_at"))


@pytest.mark.parametrize(
    "message",
    ['{"timestamp":""}', '{"tick":""}', '{"tick":"3.0"}', '{"tick":3.5}', '{"gear":"x"}', '{"rpm":"fast"}',
     '{"ignition_on":"maybe"}', '{"tick":99999999999}', '{"tyre_temp":["hot"]}'],
)
def test_unreadable_values_fail(spark, message):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW|CAST_"):
        parse_payload(_bronze(spark, message)).collect()


def test_a_filter_does_not_parse_the_message_again(spark, tmp_path):
    _bronze(spark, {"tick": 1, "rpm": 2.0}).write.parquet(str(tmp_path / "b"))
    filtered = parse_payload(spark.read.parquet(str(tmp_path / "b"))).where("rpm > 1").select("tick", "rpm")
    nodes = filtered._jdf.queryExecution().optimizedPlan().toString().splitlines()
    typed = [n for n in nodes if "from_json(StructField(timestamp,StringType,true), StructField(tick,IntegerType" in n]
    assert len(typed) == 1 and "Generate" in typed[0]
    assert filtered.count() == 1


def _keyed(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, ingested_at TIMESTAMP, timestamp TIMESTAMP, tick INT")


def test_later_load_then_higher_id_wins(spark):
    old, new, at = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 5, 1)
    rows = [(1, new, at, 1), (9, old, at, 1), (3, new, at, 2), (4, new, at, 2), (5, old, None, None),
            (6, old, None, None), (7, old, None, None), (8, old, at, None)]
    assert sorted(r.id for r in latest_wins(_keyed(spark, rows)).collect()) == [1, 4, 7, 8]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with a third of all rows sends at most one row per task."""
    rows = spark.range(0, 30000, 1, 8).select(
        "id",
        F.lit(datetime(2024, 1, 1)).alias("ingested_at"),
        F.when(F.col("id") % 3 != 0, F.timestamp_seconds("id")).alias("timestamp"),
        F.when(F.col("id") % 3 != 0, F.lit(1)).alias("tick"),
    )
    result = latest_wins(rows)
    plan = plan_of(result)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert result.count() == 20001
    assert result.where("timestamp is null").first().id == 29997


DOCUMENTS = [
    ('{"tyre_pressure":[32.0,31.45,null],"tick":1}', "[32,31.45,null]", "31.45", False),
    ('{"tyre_pressure":{"rear":[2.5],"front":1},"tick":2}', '{"front":1,"rear":[2.5]}', None, False),
    ('{"tyre_pressure":5}', "5", None, False),
    ('{"tyre_pressure":"flat"}', '"flat"', None, False),
    ('{"tyre_pressure":["x",true,{"k":[1]}]}', '["x",true,{"k":[1]}]', "true", False),
    ('{"tyre_pressure":null}', "null", None, True),
    ('{"tyre_pressure":[1],"tyre_pressure":[1,2]}', "[1,2]", "2", False),
    ('{"tick":1}', None, None, False), ("[1,2]", None, None, False), ("5", None, None, False), ("{bad", None, None, False), (None, None, None, False),
]


def test_sub_documents_stay_as_they_came(spark):
    rows = spark.createDataFrame([(k, text) for k, (text, *_) in enumerate(DOCUMENTS)], "id INT, raw_data STRING")
    found = with_documents(rows, ["tyre_pressure"])
    assert found.columns == ["id", "raw_data", "tyre_pressure_doc"]
    shown = found.select("id", F.to_json("tyre_pressure_doc").alias("text"), document_element("tyre_pressure_doc", 1).alias("second"),
                         F.is_variant_null("tyre_pressure_doc").alias("is_null"), document_element("tyre_pressure_doc", 9, "double").alias("tenth"))
    got = {r.id: (r.text, r.second, r.is_null) for r in shown.collect()}
    assert got == {k: tuple(expected) for k, (_, *expected) in enumerate(DOCUMENTS)}
    assert all(r.tenth is None for r in shown.collect())


def test_staging_with_documents(spark, tmp_path):
    message = '{"timestamp":"2024-05-01T10:00:00Z","tick":%d,"rpm":1.0,"tyre_pressure":%s,"tyre_temp":[1,2,3,4]}'
    rows = [(k, datetime(2024, 5, 1), message % (t, p)) for k, (t, p) in enumerate([(1, "[1.5,2,3,4]"), (1, '{"fl":1}'), (2, '"none"')])]
    bronze = spark.createDataFrame(rows, "id BIGINT, ingested_at TIMESTAMP, raw_data STRING")
    staged = stage(bronze, documents=True)
    assert staged.columns == [*STAGING_COLUMNS, "tyre_pressure_doc", "tyre_temp_doc"]
    staged.write.parquet(str(tmp_path / "staged"))
    back = spark.read.parquet(str(tmp_path / "staged"))
    got = {r.tick: (r.id, r.p, r.t, r.tyre_pressure_fl) for r in back.select(
        "tick", "id", F.to_json("tyre_pressure_doc").alias("p"), F.to_json("tyre_temp_doc").alias("t"), "tyre_pressure_fl").collect()}
    # The later record of a key wins with its document; what is no array has no wheels.
    assert got == {1: (1, '{"fl":1}', "[1,2,3,4]", None), 2: (2, '"none"', "[1,2,3,4]", None)}
