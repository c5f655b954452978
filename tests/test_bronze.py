import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from tachoflow.sources import bronze
from tachoflow.sources.bronze import (
    IncompleteLoad, InvalidJson, changed_folders, in_blocks, known_files, list_files, load_bronze, load_files, manifest, new_files,
    remove_old_manifests, scan_bronze,
)
from tachoflow.sources.jsonl import invalid_lines, read_lines
from tachoflow.streaming.ingest import consume_once
from tachoflow.versions import read_state

ODD = ("a b.jsonl", "p[1].jsonl", "x%y.jsonl", "h#1.jsonl", "q?z.jsonl", "b{1,2}.jsonl", "s*r.jsonl", "n+1.jsonl", "é%20.jsonl", "k\\m.jsonl")


def _fill(path, *values):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f'{{"n":{v}}}\n' for v in values))


def _values(spark, table):
    return sorted(json.loads(r.raw_data)["n"] for r in scan_bronze(spark, table).collect())


def _listed(spark, inbox):
    return next(in_blocks(list_files(spark, str(inbox)), True))


def test_odd_names_are_loaded_once(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    for k, name in enumerate(ODD):
        _fill(inbox / name, 2 * k, 2 * k + 1)
    # What the pattern of a name would match is not loaded in its place.
    _fill(inbox / "p1.jsonl", 100)
    assert consume_once(spark, str(inbox), table) == 2 * len(ODD) + 1
    assert consume_once(spark, str(inbox), table) == 0
    assert _values(spark, table) == [*range(2 * len(ODD)), 100]
    rows = {r.file_path: r for r in manifest(spark, table).collect()}
    assert len(rows) == len(ODD) + 1 and {r.n_rows for r in rows.values()} == {1, 2}
    assert load_bronze(spark, str(inbox / "a b.jsonl"), table) == 2


def test_a_vanished_file_fails_the_load(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    _fill(inbox / "a.jsonl", 1)
    _fill(inbox / "b.jsonl", 2)
    files = _listed(spark, inbox)
    os.unlink(inbox / "a.jsonl")
    with pytest.raises(Exception, match="a.jsonl"):
        load_files(spark, files, table)
    assert _values(spark, table) == [] and manifest(spark, table).count() == 0
    assert consume_once(spark, str(inbox), table) == 1
    assert _values(spark, table) == [2]


def test_a_file_that_vanishes_while_it_is_read(spark, tmp_path, monkeypatch):
    """Even where the session is set to pass over missing files."""
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    _fill(inbox / "a.jsonl", 1)
    _fill(inbox / "b.jsonl", 2)
    files, real = _listed(spark, inbox), bronze.require_json

    def late(lines):
        os.unlink(inbox / "a.jsonl")
        return real(lines)

    monkeypatch.setattr(bronze, "require_json", late)
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    try:
        with pytest.raises(Exception):
            load_files(spark, files, table)
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")
    assert _values(spark, table) == []


def test_unread_and_grown_files_fail_the_load(spark, tmp_path, monkeypatch):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    _fill(inbox / "a.jsonl", 1)
    _fill(inbox / "b.jsonl", 2)
    files = _listed(spark, inbox)
    with monkeypatch.context() as patched:
        patched.setattr(bronze, "require_json", lambda lines: lines.where("file_path not like '%a.jsonl'"))
        with pytest.raises(IncompleteLoad, match="a.jsonl"):
            load_files(spark, files, table)
    monkeypatch.setattr(bronze, "_split_bytes", lambda spark: 0)
    _fill(inbox / "a.jsonl", *range(50))
    with pytest.raises(IncompleteLoad, match="grew"):
        load_files(spark, files, table)
    assert _values(spark, table) == []


def test_blank_files_are_taken(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    inbox.mkdir()
    (inbox / "blank.jsonl").write_text(" \n\n")
    (inbox / "empty.jsonl").write_text("")
    _fill(inbox / "a.jsonl", 1)
    assert consume_once(spark, str(inbox), table) == 1
    assert new_files(spark, str(inbox), table).count() == 0
    # A file without a byte is listed once it has one.
    assert sorted(r.n_rows for r in manifest(spark, table).collect()) == [0, 1]


def test_only_changed_folders_are_looked_up(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    for day in range(4):
        for k in range(3):
            _fill(inbox / f"day={day}" / f"{k}.jsonl", day * 10 + k)
    assert consume_once(spark, f"{inbox}/*", table) == 12
    assert changed_folders(spark, list_files(spark, f"{inbox}/*"), table).count() == 0
    _fill(inbox / "day=3" / "9.jsonl", 39)
    _fill(inbox / "day=4" / "0.jsonl", 40)
    os.utime(inbox / "day=3" / "9.jsonl", (1, 1_000_000))
    changed = sorted(r.folder.rsplit("/", 1)[1] for r in changed_folders(spark, list_files(spark, f"{inbox}/*"), table).collect())
    assert changed == ["day=3", "day=4"]
    plan = known_files(spark, table, ["file:/x/day=3", "file:/x/day=4"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(folder, [file:/x/day=3,file:/x/day=4])]" in plan
    assert sorted(r.file_path[-13:] for r in new_files(spark, f"{inbox}/*", table).collect()) == ["day=3/9.jsonl", "day=4/0.jsonl"]
    assert consume_once(spark, f"{inbox}/*", table) == 2
    # A file that was filled again or taken away leaves its folder changed, and nothing is lost or repeated.
    _fill(inbox / "day=0" / "0.jsonl", 1, 2, 3, 4)
    os.unlink(inbox / "day=1" / "0.jsonl")
    assert consume_once(spark, f"{inbox}/*", table) == 4
    assert consume_once(spark, f"{inbox}/*", table) == 0


def test_manifest_parts_stay_few(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "t")
    for turn in range(18):
        _fill(inbox / f"{turn}.jsonl", turn)
    assert consume_once(spark, str(inbox), table, files_per_load=1) == 18
    runs = read_state(spark, table)[1]["runs"]
    assert sorted(r["level"] for r in runs) == [0, 0, 1, 1]
    assert manifest(spark, table).count() == 18 and _values(spark, table) == list(range(18))
    assert consume_once(spark, str(inbox), table) == 0
    # States that name the merged parts can still be read, so these stay.
    assert remove_old_manifests(spark, table, -1) == 0


def test_loads_at_once_give_distinct_growing_ids(spark, tmp_path):
    table = str(tmp_path / "t")
    for turn in range(4):
        _fill(tmp_path / f"in{turn}" / "a.jsonl", *range(turn * 100, turn * 100 + 50))
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(lambda k: load_bronze(spark, str(tmp_path / f"in{k}"), table), range(4))) == [50] * 4
    rows = scan_bronze(spark, table).collect()
    assert len({r.id for r in rows}) == 200
    for turn in range(4):
        own = [json.loads(r.raw_data)["n"] for r in sorted(rows, key=lambda r: r.id)]
        assert [v for v in own if v // 100 == turn] == list(range(turn * 100, turn * 100 + 50))
    last = max(r.id for r in rows)
    _fill(tmp_path / "late" / "a.jsonl", 999)
    load_bronze(spark, str(tmp_path / "late"), table)
    assert [json.loads(r.raw_data)["n"] for r in scan_bronze(spark, table).where(f"id > {last}").collect()] == [999]


def test_bad_lines_are_named_by_number(spark, tmp_path):
    """Over many splits, with blank lines between, counted as the lines that hold something."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    expected = []
    for name in ("a.jsonl", "b.jsonl", "c d.jsonl"):
        lines, number = [], 0
        for k in range(3000):
            if k % 7 == 3:
                lines.append("   " if k % 2 else "")
                continue
            number += 1
            bad = name != "b.jsonl" and k % 500 == 250
            lines.append(f'{{"n":{k}' + ("" if bad else "}"))
            if bad:
                expected.append((name, number, lines[-1]))
        (inbox / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = read_lines(spark, str(inbox))
        assert lines.rdd.getNumPartitions() > 8
        got = sorted((r.file_path.rsplit("/", 1)[1].replace("%20", " "), r.line_number, r.value) for r in invalid_lines(lines).collect())
        assert got == sorted(expected)
        with pytest.raises(InvalidJson) as raised:
            load_bronze(spark, str(inbox), str(tmp_path / "t"), by_name=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert str(raised.value).startswith(f"Invalid JSON on line {expected[0][1]} of file:")
    assert "a.jsonl\n" in str(raised.value) and str(raised.value).endswith(expected[0][2])


def test_numbered_messages_are_sorted_as_short_rows(spark, tmp_path):
    """Only the event's key and time are dealt and sorted, and the writer finds the lines in order."""
    from checks.catalog import _parted_messages

    events = spark.range(900).selectExpr("id as event_id", "timestamp_seconds(1700000000 + id) as ts", "repeat('x', 1000) as props")
    lines = _parted_messages(events.repartition(5))
    plan, sorts = lines._jdf.queryExecution().optimizedPlan(), []
    while True:
        if plan.nodeName() == "Sort":
            sorts.append(plan.output().size())
        if not plan.children().size():
            break
        plan = plan.children().apply(0)
    assert sorts == [2]
    lines.write.partitionBy("part").text(str(tmp_path / "in"))
    bad = invalid_lines(read_lines(spark, str(tmp_path / "in" / "*"))).collect()
    ids = [k for k in range(900) if k % 101 == 7]
    assert sorted((r.file_path.split("part=")[1][0], r.line_number) for r in bad) == sorted((str(k % 8), k // 8 + 1) for k in ids)
