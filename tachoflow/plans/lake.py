"""Where tables live: layer routing, versions of tables and views.

``write`` puts a new version of a table beside the old one; ``publish`` makes all that was
written since the last one visible. Folders below ``root`` change together, by one new state of
the lake (``tachoflow.versions``). In the catalog each table is a view over its latest version,
replaced one after the other. Either way a reader keeps the version it began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..versions import change_state, delete_folder, read_state, remove_unused, versions

LAYERS = ("bronze", "silver", "gold")
#: Stands between the name of a catalog table and that of one of its versions.
VERSION_MARK = "__v"


@dataclass(frozen=True)
class Lake:
    """Tables in one schema per layer of the catalog, or in folders below ``root``.

    ``schemas`` renames a layer; a custom name replaces the default one entirely.
    """

    spark: SparkSession
    root: str | None = None
    schemas: Mapping[str, str] = field(default_factory=dict)
    #: Written, not yet published: (layer, name) to folder or table; and views to their statements.
    staged: dict = field(default_factory=dict, compare=False)
    staged_views: dict = field(default_factory=dict, compare=False)

    def schema_of(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return (self.schemas.get(layer) or layer).strip()

    def path(self, layer: str, name: str) -> str:
        if not self.root:
            raise ValueError("this lake keeps its tables in the catalog, not in folders")
        return f"{self.root.rstrip('/')}/{self.schema_of(layer)}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema_of(layer)}.{name}"

    def create_schemas(self) -> None:
        if not self.root:
            for layer in LAYERS:
                self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema_of(layer)}")

    def write(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        buckets: tuple[int, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Write a new version of one table and return it; others see it after ``publish``.

        ``buckets`` (catalog tables only) keeps rows hashed by their key, so that later
        jobs on that key need no shuffle.
        """
        version = uuid.uuid4().hex
        writer = df.write.format("parquet")
        if self.root:
            place = f"{self.path(layer, name)}/version={version}"
            writer.save(place)
        else:
            if buckets:
                count, keys = buckets
                writer = writer.bucketBy(count, *keys)
            place = f"{self.table(layer, name)}{VERSION_MARK}{version}"
            writer.saveAsTable(place)
        self.staged[layer, name] = place
        return self._open(place)

    def view(self, layer: str, name: str, statement: str, sources: Mapping[str, tuple[str, str]]) -> None:
        """Stage a lasting view: SQL text whose ``{names}`` stand for tables, given as (layer, name)."""
        self.staged_views[layer, name] = (statement, {key: list(source) for key, source in sources.items()})

    def publish(self) -> int:
        """Show all staged tables and views; returns the number of the lake's version (0 in the catalog)."""
        number = 0
        if self.root:
            added = {
                "tables": {"/".join(key): place for key, place in self.staged.items()},
                "views": {"/".join(key): list(view) for key, view in self.staged_views.items()},
            }
            change_state(self.spark, self.root, lambda s: {kind: {**s.get(kind, {}), **new} for kind, new in added.items()})
            number = read_state(self.spark, self.root)[0]
        else:
            for (layer, name), place in self.staged.items():
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.table(layer, name)} AS SELECT * FROM {place}")
            for (layer, name), (statement, sources) in self.staged_views.items():
                text = statement.format(**{key: self.table(*source) for key, source in sources.items()})
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.table(layer, name)} AS {text}")
        self.staged.clear()
        self.staged_views.clear()
        return number

    def discard(self) -> None:
        """Delete what was written and never published."""
        for place in self.staged.values():
            if self.root:
                delete_folder(self.spark, place)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {place}")
        self.staged.clear()
        self.staged_views.clear()

    def versions(self) -> list[int]:
        """Numbers of the versions of a lake in folders that can still be read."""
        return versions(self.spark, self.root) if self.root else []

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """A published table or view; with ``version`` (folders only) as of that version of the lake."""
        if not self.root:
            return self.spark.read.table(self.table(layer, name))
        number, state = read_state(self.spark, self.root, version)
        key = f"{layer}/{name}"
        if key in state.get("views", {}):
            statement, sources = state["views"][key]
            return self.spark.sql(statement, **{k: self.read(*source, version=number) for k, source in sources.items()})
        if key not in state.get("tables", {}):
            raise ValueError(f"{key} is not published")
        return self._open(state["tables"][key])

    def remove_old(self, seconds: float = 7 * 86_400) -> int:
        """Delete versions of tables that no readable version of the lake uses (catalog: that no view shows)."""
        if self.root:
            return sum(
                len(remove_unused(self.spark, self.root, self.path(*key.split("/")), seconds, _version_folders))
                for key in read_state(self.spark, self.root)[1].get("tables", {}))
        gone = 0
        for layer in LAYERS:
            tables = [t for t in self.spark.catalog.listTables(self.schema_of(layer)) if VERSION_MARK in t.name]
            for table in tables:
                shown = table.name.split(VERSION_MARK)[0]
                if not self._shows(layer, shown, table.name):
                    self.spark.sql(f"DROP TABLE {self.table(layer, table.name)}")
                    gone += 1
        return gone

    def _shows(self, layer: str, view: str, place: str) -> bool:
        if not self.spark.catalog.tableExists(self.table(layer, view)):
            return True
        text = self.spark.sql(f"SHOW CREATE TABLE {self.table(layer, view)}").first()[0]
        return place in text

    def _open(self, place: str) -> DataFrame:
        return self.spark.read.parquet(place) if self.root else self.spark.read.table(place)


def _version_folders(state: dict) -> set[str]:
    return {place.rsplit("/", 1)[1] for place in state.get("tables", {}).values()}
