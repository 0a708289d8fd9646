"""A catalog of keyed tables over Spark's own: table models and keys live in table properties."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.text import quote_ident
from millrace.plans.tables import ColumnDef, Model, TableDef
from millrace.sources.options import CatalogOptions, SinkOptions

PROPERTY = "millrace.table"


class Catalog:
    def __init__(self, spark: SparkSession, options: CatalogOptions | None = None):
        self.spark, self.options = spark, options or CatalogOptions()

    # databases
    def list_databases(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def database_exists(self, name: str) -> bool:
        return self.spark.catalog.databaseExists(name)

    def create_database(self, name: str, *, ignore_if_exists: bool = True) -> None:
        if self.database_exists(name) and not ignore_if_exists:
            raise ValueError(f"database {name} exists")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(name)}")

    # tables
    def _name(self, database: str, table: str) -> str:
        return f"{quote_ident(database)}.{quote_ident(table)}"

    def list_tables(self, database: str) -> list[str]:
        if not self.database_exists(database):
            raise ValueError(f"no database {database}")
        return sorted(t.name for t in self.spark.catalog.listTables(database) if not t.isTemporary)

    def table_exists(self, database: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self._name(database, table))

    def create_table(self, table: TableDef, *, ignore_if_exists: bool = False) -> None:
        """A table in Parquet, bucketed by its distribution keys where a number of buckets is given, so that joins and
        merges on them need no shuffle. Key columns come first."""
        if self.table_exists(table.database, table.name):
            if ignore_if_exists:
                return
            raise ValueError(f"table {table.database}.{table.name} exists")
        if table.keys:
            table = table.keys_first()
        if table.buckets is None and self.options.buckets is not None:
            table = replace(table, buckets=self.options.buckets)
        cols = ", ".join(_spark_column(c) for c in table.columns)
        sql = f"CREATE TABLE {self._name(table.database, table.name)} ({cols}) USING parquet"
        by = table.distribution or table.keys
        if table.buckets and by:
            sql += f" CLUSTERED BY ({', '.join(map(quote_ident, by))}) INTO {table.buckets} BUCKETS"
        if table.comment:
            sql += f" COMMENT '{_escaped(table.comment)}'"
        props = {**self.options.table, **table.properties, PROPERTY: _dump(table)}
        sql += " TBLPROPERTIES (" + ", ".join(f"'{_escaped(k)}' = '{_escaped(v)}'" for k, v in props.items()) + ")"
        self.spark.sql(sql)

    def get_table(self, database: str, table: str) -> TableDef:
        if not self.table_exists(database, table):
            raise ValueError(f"no table {database}.{table}")
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._name(database, table)}").collect()
        found = {r["key"]: r["value"] for r in rows}
        if PROPERTY in found:
            return _load(found[PROPERTY])
        from millrace.plans.tables import from_frame

        return from_frame(database, table, self.spark.table(self._name(database, table)).schema)

    def sink_options(self, database: str, table: str) -> SinkOptions:
        return self.options.sink_for(database, table)

    def table(self, database: str, table: str) -> DataFrame:
        """The rows, in the columns that the newest definition has."""
        known = [quote_ident(c.name) for c in self.get_table(database, table).columns]
        return self.spark.table(self._name(database, table)).select(*known)

    def drop_table(self, database: str, table: str, *, ignore_if_not_exists: bool = False) -> None:
        if not self.table_exists(database, table) and not ignore_if_not_exists:
            raise ValueError(f"no table {database}.{table}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(database, table)}")

    # columns
    def add_columns(self, database: str, table: str, added: Sequence[ColumnDef]) -> TableDef:
        """New columns at the end; rows that are there hold null."""
        now = self.get_table(database, table)
        taken = [c.name for c in added if now.column(c.name)]
        if taken:
            raise ValueError(f"columns exist: {taken}")
        listed = ", ".join(_spark_column(replace(c, nullable=True)) for c in added)
        self.spark.sql(f"ALTER TABLE {self._name(database, table)} ADD COLUMNS ({listed})")
        return self._describe(replace(now, columns=(*now.columns, *added)))

    def drop_columns(self, database: str, table: str, names: Sequence[str]) -> TableDef:
        """A new version of the definition without these columns. Files keep them unread: columnar scans skip them."""
        now = self.get_table(database, table)
        low = {n.lower() for n in names}
        if missing := low - {c.name.lower() for c in now.columns}:
            raise ValueError(f"no such columns: {sorted(missing)}")
        if keys := [k for k in (*now.keys, *now.distribution) if k.lower() in low]:
            raise ValueError(f"keys cannot be dropped: {keys}")
        return self._describe(replace(now, columns=tuple(c for c in now.columns if c.name.lower() not in low)))

    def _describe(self, table: TableDef) -> TableDef:
        self.spark.sql(f"ALTER TABLE {self._name(table.database, table.name)} SET TBLPROPERTIES ('{PROPERTY}' = '{_escaped(_dump(table))}')")
        return table

    # what such catalogs do not do
    def _unsupported(self, *_, **__):
        raise NotImplementedError("the catalog does not support this")

    alter_database = drop_database = alter_table = rename_table = create_view = list_partitions = create_function = _unsupported

    def list_views(self, database: str) -> list[str]:
        return []

    def list_functions(self, database: str) -> list[str]:
        return []

    def statistics(self, database: str, table: str) -> None:
        """Unknown: statistics are left to the file footers."""
        return None


def _spark_column(c: ColumnDef) -> str:
    f = c.field()
    about = f" COMMENT '{_escaped(c.comment)}'" if c.comment else ""
    return f"{quote_ident(c.name)} {f.dataType.simpleString()}{'' if c.nullable else ' NOT NULL'}{about}"


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _dump(table: TableDef) -> str:
    return json.dumps(asdict(table) | {"model": table.model.name})


def _load(text: str) -> TableDef:
    raw = json.loads(text)
    raw["columns"] = tuple(ColumnDef(**c) for c in raw["columns"])
    raw["keys"], raw["distribution"] = tuple(raw["keys"]), tuple(raw["distribution"])
    return TableDef(**raw | {"model": Model[raw["model"]]})
