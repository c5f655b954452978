"""Run registered queries next to their SQL and compare the rows.

Usage: python -m checks.compare FOLDER [query ...]
"""

from __future__ import annotations

import glob
import math
import sys
import time
from pathlib import Path

import duckdb

from tachoflow.session import build_session


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


def difference(spark, folder: str, name: str, query, sql: str | None) -> str | None:
    """None if both sides agree, else what differs."""
    result = query(spark, folder)
    columns = result.columns
    got = _rows(columns, result.collect())
    if sql is None:
        return None
    with duckdb.connect() as db:
        for file in glob.glob(f"{folder}/*.parquet"):
            db.execute(f"create view {Path(file).stem} as select * from read_parquet('{file}')")
        answer = db.execute(sql)
        names = [d[0] for d in answer.description]
        expected = _rows(names, answer.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(set(columns) ^ set(names))}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    from checks.catalog import all_queries
    from checks.oracle import all_oracles

    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    found, oracles = all_queries(), all_oracles()
    failures = 0
    for name in names or found:
        start = time.time()
        try:
            problem = difference(spark, folder, name, found[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    missing = sorted(set(found) ^ set(oracles))
    print(f"{failures} failed, without counterpart: {missing}")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
