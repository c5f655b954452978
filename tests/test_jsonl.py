import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tachoflow.sources.bronze import load_bronze, scan_bronze
from tachoflow.sources.jsonl import is_single_json, read_lines

LINES = [
    '{"a":1}', '{"a":1,"a":2}', "[1]", "5", '"x"', "null", "true", "1.5e3", '{"a":{"b":[[{}]]}}',
    '{"a":1} junk', "{'a':1}", "1, 2", '1} , {"v":2', "1] , [2", "{bad", '1, "k":2', '{"a":1}}',
    '{"a":[1,2}', '{"a":01}', '{"a":1,}', "tru", '{"a":"x\ty"}', '{"a":"\\x"}', '{"a":1}{"b":2}',
    "/*c*/ 1", "{a:1}", "1.", "+1", "﻿1", '{"a":"\\u12"}', "nul", '"a" "b"', '{"v":1} , 2',
    '{"a":1}],[{"b":1}', '{"_bad":1}', '{"_none":{"x":1}}', "{}", "[]",
]
NOT_NUMBERS = ['{"a":NaN}', "-Infinity", '{"a":[Infinity]}']
DAY = datetime(2024, 5, 1, tzinfo=timezone.utc)


def _parses(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_single_json_agrees_with_a_strict_parser(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "line STRING")
    got = {r.line: r.ok for r in df.select("line", is_single_json(F.col("line")).alias("ok")).collect()}
    assert got == {line: _parses(line) for line in LINES}


def test_numbers_without_a_value_are_refused(spark):
    df = spark.createDataFrame([(line,) for line in NOT_NUMBERS], "line STRING")
    assert df.where(is_single_json(F.col("line"))).count() == 0


def test_blank_lines_are_dropped_and_padding_is_stripped(spark, tmp_path):
    file = tmp_path / "in.jsonl"
    file.write_text('\n   \n\t  {"tick":1} 　\r\n\x85\n{"tick":2}\n', encoding="utf-8")
    lines = [r.value for r in read_lines(spark, str(file)).orderBy("position").collect()]
    assert lines == ['{"tick":1}', '{"tick":2}']


@pytest.mark.parametrize("content", [None, "", "  \n\n"])
def test_missing_or_blank_input_loads_nothing(spark, tmp_path, content):
    source, table = tmp_path / "in.jsonl", tmp_path / "bronze"
    if content is not None:
        source.write_text(content)
    assert load_bronze(spark, str(source), str(table)) == 0
    assert not table.exists()
    assert scan_bronze(spark, str(table)).count() == 0


def test_ids_follow_file_order_across_many_splits(spark, tmp_path):
    inbox, table = tmp_path / "in", tmp_path / "bronze"
    inbox.mkdir()
    # Short lines of uneven length, the shortest possible ones included.
    names = ["a.jsonl", "b.jsonl", "c.jsonl"]
    expected = []
    for part, name in enumerate(names):
        rows = [f'{{"n":{part * 10000 + i}}}' if i % 3 else "7" for i in range(4000)]
        expected += rows
        (inbox / name).write_text("\n".join(rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert read_lines(spark, str(inbox)).rdd.getNumPartitions() > 8
        assert load_bronze(spark, str(inbox), str(table), by_name=True) == len(expected)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    loaded = scan_bronze(spark, str(table)).orderBy("id").collect()
    assert [r.raw_data for r in loaded] == expected
    assert len({r.id for r in loaded}) == len(expected)


def test_later_loads_continue_the_ids(spark, tmp_path):
    source, table = tmp_path / "in.jsonl", tmp_path / "bronze"
    for value in (1, 2, 3):
        source.write_text(f'{{"n":{value}}}\n')
        load_bronze(spark, str(source), str(table), ingested_at=DAY)
    rows = scan_bronze(spark, str(table)).orderBy("id").collect()
    assert [r.raw_data for r in rows] == ['{"n":1}', '{"n":2}', '{"n":3}']


def test_one_bad_line_fails_the_whole_load(spark, tmp_path):
    source, table = tmp_path / "in.jsonl", tmp_path / "bronze"
    source.write_text('{"n":1}\n{bad\n{"n":2}\n')
    with pytest.raises(Exception, match="Invalid JSON in .*in.jsonl at position 1: .bad"):
        load_bronze(spark, str(source), str(table))
    assert scan_bronze(spark, str(table)).count() == 0


def test_quarantine_takes_bad_lines(spark, tmp_path):
    source, table, bad = tmp_path / "in.jsonl", tmp_path / "bronze", tmp_path / "bad"
    source.write_text('{"n":1}\n{"n":1} junk\n{"n":2}\n')
    assert load_bronze(spark, str(source), str(table), quarantine=str(bad)) == 2
    assert [r.value for r in spark.read.parquet(str(bad)).collect()] == ['{"n":1} junk']
