"""Databases, views and the ways a table is replaced.

Files are always written first, under a name no reader knows, and published by one catalog
statement. A job that dies halfway therefore leaves the published data as it was.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources import files

# The three layers are databases of the same name.
LAYERS = ("raw", "stg", "dwh")
VERSION = "starloom.version"
_COMMIT, _AT, _NOTE = "__c", "starloom.at.", "starloom.note."
# Commits of a table that stay: the latest, and those that running readers may have begun with.
KEPT = 3
# Half the size of the default codec on hash keys and ids, at the same write time.
CODEC = "zstd"


class Conflict(Exception):
    """Another writer has published what this one was about to replace."""


@dataclass(frozen=True)
class State:
    """A commit of a partitioned table: its number, folders by partition spec, and notes."""

    number: int
    partitions: dict[str, str]
    notes: dict[str, str]


class Warehouse:
    """A root folder on shared storage plus the layer databases that point into it.

    `prefix` keeps several warehouses apart in one catalog; without it the databases are named
    exactly like the layers. Partitioned tables take several writers, other tables one at a time.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        for layer in LAYERS:
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"LOCATION '{self.root}/{layer}'"
            )
            found = spark.catalog.getDatabase(f"{prefix}{layer}").locationUri
            if files.qualified(spark, found) != files.qualified(spark, f"{self.root}/{layer}"):
                raise ValueError(f"database {prefix}{layer} already lies in {found}")

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"not a layer: {layer!r} (expected one of {LAYERS})")
        return f"`{self.prefix}{layer}`"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.`{table}`"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def has(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def new_run(self, run_ts: datetime) -> str:
        return f"{run_ts:%Y%m%d%H%M%S}_{uuid.uuid4().hex[:12]}"

    # -- views and whole tables ------------------------------------------------------------

    def create_view(
        self, layer: str, view: str, columns: list[str], source: str, where: str = "",
        properties: dict[str, str] | None = None,
    ) -> None:
        """Create or replace a view; `source` is a qualified name."""
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, view)} "
            + (f"TBLPROPERTIES ({listed}) " if listed else "")
            + f"AS SELECT {', '.join(columns)} FROM {source}"
            + (f" WHERE {where}" if where else "")
        )

    def properties(self, layer: str, name: str) -> dict[str, str]:
        """Properties of a table or view; none if it does not exist."""
        if not self.has(layer, name):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, name)}").collect()
        return {r["key"]: r["value"] for r in rows}

    def replace_table(self, layer: str, table: str, rows: DataFrame, run_ts: datetime) -> None:
        """Write `rows` as a new version and point the view `table` at it.

        `rows` may read the version being replaced. That version stays for readers that have
        already started; the one before it is dropped.
        """
        version = f"{table}__{self.new_run(run_ts)}"
        previous = self.properties(layer, table).get(VERSION)
        rows.write.format("parquet").option("compression", CODEC).saveAsTable(
            self.name(layer, version)
        )
        columns = [f"`{c}`" for c in rows.columns]
        self.create_view(
            layer, table, columns, self.name(layer, version), properties={VERSION: version}
        )
        listed = self.spark.sql(
            f"SHOW TABLES IN {self.database(layer)} LIKE '{table}__*'"
        ).collect()
        for row in listed:
            if row["tableName"] not in (version.lower(), version, previous):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, row['tableName'])}")

    # -- partitioned tables ----------------------------------------------------------------
    #
    # A partitioned table is a view on its latest commit. A commit is an external table of its own,
    # named by a number, whose properties say where each partition lies; its creation is the
    # moment it happens, and the catalog lets only one writer create a name. The view is pointed at it
    # afterwards, in one catalog change for any number of partitions.

    def create_partitioned(
        self, layer: str, table: str, schema: T.StructType, partitions: T.StructType
    ) -> None:
        """Make an empty table, unless it is there already."""
        if self._finished(layer, table).number >= 0:
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in partitions)
        try:
            self._create_commit(layer, table, State(0, {}, {}), f"{columns}, {keys}", partitions.names)
        except Conflict:
            pass  # another writer has just made it
        self._point(layer, table)

    def state(self, layer: str, table: str) -> State:
        """The latest commit: its number, where the partitions lie, and the table's notes."""
        numbers = self._commits(layer, table)
        if not numbers:
            return State(-1, {}, {})
        found = self._state(layer, table, numbers[-1])
        if found is None:  # dropped in the meantime, as newer ones have come
            return self.state(layer, table)
        return found

    def commit(
        self,
        layer: str,
        table: str,
        put: dict[str, str],
        drop: Iterable[str] = (),
        notes: dict[str, str] | None = None,
        since: State | None = None,
    ) -> State:
        """Publish partition folders, drop others and add notes, all at once.

        `since` is the state the change was computed from, by default the latest. If other commits have
        come since, the change goes on top of them, unless they changed the same partitions: then it is
        a Conflict, and nothing is published. A job that dies before its commit exists leaves nothing;
        one that dies right after is finished by the next writer, and readers see the state before until
        then.
        """
        base = self._finished(layer, table)
        since = since or base
        touched = {*put, *drop}
        while True:
            changed = {
                s for s in touched if base.partitions.get(s) != since.partitions.get(s)
            }
            if changed:
                raise Conflict(f"{table}: {', '.join(sorted(changed))} changed by commit {base.number} or before")
            partitions = {s: f for s, f in base.partitions.items() if s not in set(drop)} | put
            after = State(base.number + 1, partitions, base.notes | (notes or {}))
            try:
                self._create_commit(layer, table, after)
                break
            except Conflict:
                base = self._finished(layer, table)
        self._point(layer, table)
        self._clean(layer, table)
        return after

    def commits(self, layer: str, table: str) -> DataFrame:
        """The manifest: commit, partition and folder of every commit that is still kept."""
        rows = []
        for number in self._commits(layer, table):
            found = self._state(layer, table, number)
            rows += [(number, s, f) for s, f in found.partitions.items()] if found else []
        return self.spark.createDataFrame(rows, "commit long, partition string, folder string")

    def partitions(self, layer: str, table: str) -> list[str]:
        """Published partition specs, such as 'load_month=2019-01'."""
        return sorted(self.state(layer, table).partitions)

    def partition_location(self, layer: str, table: str, spec: str) -> str:
        return self.state(layer, table).partitions[spec]

    def staged(self, folder: str, within: str = "") -> dict[str, str]:
        """The partition folders written below a folder, by spec; `within` names an outer partition."""
        outer = f"{within}/" if within else ""
        return {
            f"{outer}{inner}": f"{folder}/{inner}"
            for inner in files.subfolders(self.spark, folder)
            if "=" in inner
        }

    def _commits(self, layer: str, table: str) -> list[int]:
        """Numbers of the commits that are kept, in order."""
        listed = self.spark.sql(
            f"SHOW TABLES IN {self.database(layer)} LIKE '{table}{_COMMIT}*'"
        ).collect()
        names = [r["tableName"].removeprefix(f"{table}{_COMMIT}".lower()) for r in listed]
        return sorted(int(n) for n in names if n.isdigit())

    def _commit_name(self, table: str, number: int) -> str:
        return f"{table}{_COMMIT}{number:09d}"

    def _state(self, layer: str, table: str, number: int) -> State | None:
        known = self.properties(layer, self._commit_name(table, number))
        if not known:
            return None
        cut = {
            at: {k.removeprefix(at): v for k, v in known.items() if k.startswith(at)} for at in (_AT, _NOTE)
        }
        folders = {s: f if ":" in f or f.startswith("/") else f"{self.root}/{f}" for s, f in cut[_AT].items()}
        return State(number, folders, cut[_NOTE])

    def _create_commit(
        self, layer: str, table: str, state: State, columns: str = "", keys: list[str] = ()
    ) -> None:
        """Create a commit; Conflict if there is one of this number."""
        if not columns:
            listed = self.spark.catalog.listColumns(
                self.name(layer, self._commit_name(table, state.number - 1))
            )
            columns = ", ".join(f"`{c.name}` {c.dataType}" for c in listed)
            keys = [c.name for c in listed if c.isPartition]
        noted = {_AT + s: f.removeprefix(f"{self.root}/") for s, f in state.partitions.items()}
        noted |= {_NOTE + k: v for k, v in state.notes.items()} | {VERSION: str(state.number)}
        listed = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in sorted(noted.items()))
        try:
            self.spark.sql(
                f"CREATE TABLE {self.name(layer, self._commit_name(table, state.number))} ({columns}) "
                f"USING parquet PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)}) "
                f"LOCATION '{_quoted(self.root)}/{layer}/commits/{table}' TBLPROPERTIES ({listed})"
            )
        except AnalysisException as error:
            if "ALREADY_EXISTS" in (error.getCondition() or ""):
                raise Conflict(f"{table}: commit {state.number} exists already") from None
            raise

    def _point(self, layer: str, table: str) -> None:
        """Register the latest commit's partitions and point the view at it; again, if it is overtaken."""
        pointed = None
        while True:
            latest = self.state(layer, table)
            if latest.number == pointed:
                return
            name = self.name(layer, self._commit_name(table, latest.number))
            added = " ".join(
                f"PARTITION ({_sql_spec(s)}) LOCATION '{_quoted(f)}'" for s, f in latest.partitions.items()
            )
            if added:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
            columns = [f"`{c}`" for c in self.spark.table(name).columns]
            self.create_view(layer, table, columns, name, properties={VERSION: str(latest.number)})
            pointed = latest.number

    def _finished(self, layer: str, table: str) -> State:
        """The latest commit, published first if its writer died before it could."""
        latest = self.state(layer, table)
        if latest.number >= 0 and self.properties(layer, table).get(VERSION) != str(latest.number):
            self._point(layer, table)
        return latest

    def _clean(self, layer: str, table: str) -> None:
        """Drop commits that no reader is expected to be at any more, and the files only they name.

        The new commit is published by now. What cannot be deleted is left behind with a warning; it
        is no reason for a load to fail.
        """
        try:
            numbers = self._commits(layer, table)
            old, kept = numbers[:-KEPT], numbers[-KEPT:]
            states = [self._state(layer, table, n) for n in kept]
            needed = {f for s in states if s for f in s.partitions.values()}
            for number in old:
                known = self._state(layer, table, number)
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, self._commit_name(table, number))}")
                for folder in set(known.partitions.values()) - needed if known else ():
                    files.delete(self.spark, folder)
        except Exception as error:
            warnings.warn(f"replaced files of {table} were left behind: {error}", stacklevel=2)


def write_partitioned(rows: DataFrame, partition: str, folder: str) -> None:
    rows.write.partitionBy(partition).option("compression", CODEC).parquet(folder)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _sql_spec(spec: str) -> str:
    parts = [p.split("=", 1) for p in spec.split("/")]
    return ", ".join(f"`{k}` = '{v}'" for k, v in parts)
