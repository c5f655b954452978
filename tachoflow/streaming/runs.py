"""Tables that a stream appends to, batch by batch.

Every batch writes one run: a folder below each of its tables. One state for all tables
(``tachoflow.versions``) names the runs, so a batch shows up in all of them at once or not at
all, and a batch that comes again after a crash is met by its number and left out. Runs are
merged level by level, so that reading resolves a bounded number of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..versions import RUNS_PER_LEVEL, change_state, new_run, read_state, remove_unused, replace_runs, runs_to_merge

Rows = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunTables:
    """Tables below one folder: name to what makes one run out of the rows of several."""

    spark: SparkSession
    root: str
    merges: Mapping[str, Rows]
    partition_by: Sequence[str] = ()
    runs_per_level: int = RUNS_PER_LEVEL

    def runs(self) -> list[dict]:
        return read_state(self.spark, self.root)[1].get("runs", [])

    def append(self, batch: Mapping[str, DataFrame], number: int, stream: str = "") -> bool:
        """Add one batch of a stream (named by its checkpoint); False if it was there already."""
        if self._has(read_state(self.spark, self.root)[1], number, stream):
            return False
        run = {"name": new_run(), "level": 0}
        for name, rows in batch.items():
            self._write(name, run["name"], rows)
        added = []

        def change(state: dict) -> dict | None:
            added.clear()
            if self._has(state, number, stream):
                return None
            added.append(True)
            last = {**state.get("last", {}), stream: number}
            return {**state, "runs": [*state.get("runs", []), run], "last": last}

        change_state(self.spark, self.root, change)
        return bool(added)

    def compact(self) -> int:
        """Merge runs until no level is full; returns the number of merges.

        The merged run is written first and then takes the place of its parts in one step, so
        a crash leaves the old runs in place and an append meanwhile stays.
        """
        merges = 0
        while full := runs_to_merge(self.runs(), self.runs_per_level):
            run = {"name": new_run(), "level": full[0]["level"] + 1}
            for name, merge in self.merges.items():
                self._write(name, run["name"], merge(self._read(name, full)))
            merges += replace_runs(self.spark, self.root, full, run)
        return merges

    def read(self, name: str) -> DataFrame:
        """All rows of one table, as of the last batch."""
        return self._read(name, self.runs())

    def remove_old(self, seconds: float = 7 * 86_400) -> int:
        """Delete runs that were merged into others so long ago."""
        return sum(len(remove_unused(self.spark, self.root, f"{self.root}/{name}", seconds)) for name in self.merges)

    @staticmethod
    def _has(state: dict, number: int, stream: str) -> bool:
        return number <= state.get("last", {}).get(stream, -1)

    def _write(self, name: str, run: str, rows: DataFrame) -> None:
        rows.write.partitionBy(*self.partition_by).parquet(f"{self.root}/{name}/{run}")

    def _read(self, name: str, runs: Sequence[dict]) -> DataFrame:
        base = f"{self.root}/{name}"
        paths = [f"{base}/{run['name']}" for run in runs]
        return self.spark.read.option("basePath", base).parquet(*paths).drop("run")


def together(rows: DataFrame) -> DataFrame:
    """Merge of a table whose runs do not touch each other: few files of even size."""
    return rows.hint("rebalance")
