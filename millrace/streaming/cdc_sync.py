"""Whole-database sync: one stream of change envelopes into all tables of a store, with schema changes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.types import mysql_to_remote
from millrace.operators import changelog, keyed
from millrace.plans.tables import ColumnDef, Model, TableDef
from millrace.sources.options import SinkOptions
from millrace.streaming import sink
from millrace.streaming.commit import CommitLog


@dataclass(frozen=True)
class SourceColumn:
    name: str
    kind: str
    length: int | None = None
    scale: int | None = None
    nullable: bool = True
    comment: str | None = None


@dataclass(frozen=True)
class SourceTable:
    database: str
    name: str
    columns: tuple[SourceColumn, ...]
    keys: tuple[str, ...] = ()


@dataclass
class DatabaseSync:
    """Discover tables, name their targets, create them, and keep them up to date from one stream."""

    spark: SparkSession
    log: CommitLog
    database: str
    prefix: str = ""
    suffix: str = ""
    including: str | None = None
    excluding: str | None = None
    evolve: bool = True
    options: SinkOptions = field(default_factory=lambda: SinkOptions(semantic="exactly-once", format="json"))
    table_options: Mapping[str, str] = field(default_factory=dict)
    tables: dict[str, TableDef] = field(default_factory=dict)

    def discover(self, sources: list[SourceTable]) -> dict[str, TableDef]:
        """Targets for the source tables that take part. A table without a primary key is left out."""
        names = changelog.table_matches([s.name for s in sources], self.including, self.excluding)
        for s in sources:
            if s.name not in names or not s.keys:
                continue
            kinds = {c.name: mysql_to_remote(c.kind, c.length, c.scale).replace("DATEV2", "DATE").replace("JSONB", "JSON") for c in s.columns}
            cols = tuple(ColumnDef(c.name, _sized(kinds[c.name]), c.nullable and c.name not in s.keys, comment=c.comment) for c in s.columns)
            target = f"{self.prefix}{s.name}{self.suffix}"
            table = TableDef(self.database, target, cols, Model.PRIMARY_KEY, s.keys, properties=dict(self.table_options))
            self.tables[f"{self.database}.{target}"] = table.keys_first()
        return self.tables

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: column changes first, then rows, in one commit over all tables."""
        batch = batch.persist()
        try:
            if self.evolve:
                self.change_columns(batch)
            routed = changelog.route(batch, prefix=self.prefix, suffix=self.suffix, including=self.including, excluding=self.excluding)
            routed = routed.drop("db").selectExpr("*", f"'{self.database}' as db")
            sink.batch_writer(self.log, self.tables, sink.split_by_route(), self.options, prefix="cdc")(routed, batch_id)
        finally:
            batch.unpersist()

    def change_columns(self, batch: DataFrame) -> int:
        """Apply added and dropped columns to the definitions; snapshots take the new shape at their next write."""
        done = 0
        for r in changelog.column_changes(batch).collect():  # statements, not rows: a handful in a batch
            key = f"{self.database}.{self.prefix}{r.tbl}{self.suffix}"
            table = self.tables.get(key)
            if table is None:
                continue
            name = r.column_name.strip("`;")
            own = table.column(name)
            if r.action == "add" and own is None:
                table = replace(table, columns=(*table.columns, ColumnDef(name, _sized((r.column_type or "string").strip(";")))))
            elif r.action == "drop" and own is not None and name not in table.keys:
                table = replace(table, columns=tuple(c for c in table.columns if c is not own))
            else:
                continue
            self.tables[key] = table
            done += 1
            self._reshape(table)
        return done

    def _reshape(self, table: TableDef) -> None:
        base = self.log.read(table.database, table.name)
        if base is None:
            return
        one = f"schema-{table.name}-{len(table.columns)}-{self.log.latest().number + 1}"
        where = self.log.stage(keyed.conform(base, table.schema), table.database, table.name, one)
        key = f"{table.database}.{table.name}"
        self.log.publish(one, {key: where}, replace=[key])

    def start(self, stream: DataFrame, checkpoint: str, *, interval_ms: int | None = None):
        return sink.start(stream, self.write, checkpoint, interval_ms=interval_ms)


def _sized(kind: str) -> str:
    """MySQL spells some types otherwise than table DDL; a bare varchar gets the largest size."""
    plain = kind.strip().lower()
    known = {"int": "INT", "integer": "INT", "varchar": "STRING", "char": "STRING", "text": "STRING", "boolean": "BOOLEAN"}
    return known.get(plain, kind.upper())
