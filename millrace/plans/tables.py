"""Table definitions: columns, models, keys, aggregate functions; their DDL text and the checks before a write."""

from __future__ import annotations

import enum
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from millrace.functions.text import quote_ident
from millrace.functions.types import accepts, from_spark_type, parse_type


class Model(enum.Enum):
    UNKNOWN = "unknown"
    DUPLICATE_KEY = "duplicate"
    AGGREGATE = "aggregate"
    UNIQUE_KEY = "unique"
    PRIMARY_KEY = "primary"


#: Functions that an aggregate column may have.
AGGREGATES = (
    "SUM", "MAX", "MIN", "REPLACE", "HLL_UNION", "NONE", "BITMAP_UNION", "REPLACE_IF_NOT_NULL", "PERCENTILE_UNION",
)


@dataclass(frozen=True)
class ColumnDef:
    name: str
    kind: str  # as remote DDL spells it
    nullable: bool = True
    default: str | None = None
    comment: str | None = None
    aggregate: str = "NONE"

    def __post_init__(self):
        if self.aggregate not in AGGREGATES:
            raise ValueError(f"unknown aggregate function {self.aggregate}")

    def ddl(self) -> str:
        bare = (self.default or "").upper() == "CURRENT_TIMESTAMP" and self.kind.upper() == "DATETIME"
        parts = [quote_ident(self.name), self.kind.upper(), "NULL" if self.nullable else "NOT NULL"]
        if self.default is not None:
            parts.append(f"DEFAULT {self.default}" if bare else f'DEFAULT "{self.default}"')
        if self.comment is not None:
            parts.append(f'COMMENT "{self.comment}"')
        return " ".join(parts)

    def field(self) -> T.StructField:
        about = {"default": self.default, "comment": self.comment, "aggregate": self.aggregate, "remote": self.kind}
        return T.StructField(self.name, parse_type(self.kind), self.nullable, {k: v for k, v in about.items() if v})


@dataclass(frozen=True)
class TableDef:
    database: str
    name: str
    columns: tuple[ColumnDef, ...]
    model: Model = Model.DUPLICATE_KEY
    keys: tuple[str, ...] = ()
    sequence: str | None = None
    distribution: tuple[str, ...] = ()
    buckets: int | None = None
    comment: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        names = [c.name for c in self.columns]
        missing = [k for k in (*self.keys, *self.distribution) if k not in names]
        if missing:
            raise ValueError(f"keys without a column: {missing}")
        if self.model is Model.PRIMARY_KEY and not self.keys:
            raise ValueError("a primary key table has keys")

    @property
    def schema(self) -> T.StructType:
        """The schema of frames of this table: texts of limited length are strings, as frames have no other."""
        fields = [c.field() for c in self.columns]
        text = (T.CharType, T.VarcharType)
        kinds = [T.StringType() if isinstance(f.dataType, text) else f.dataType for f in fields]
        return T.StructType([T.StructField(f.name, k, f.nullable, f.metadata) for f, k in zip(fields, kinds, strict=True)])

    def column(self, name: str) -> ColumnDef | None:
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)

    def keys_first(self) -> TableDef:
        """The same table with its key columns in front, in key order."""
        front = [self.column(k) for k in self.keys]
        return replace(self, columns=(*front, *[c for c in self.columns if c not in front]))

    def create_sql(self, *, if_not_exists: bool = False) -> str:
        """DDL for a primary key table, hashed by its keys unless it says otherwise."""
        if self.model is not Model.PRIMARY_KEY:
            raise ValueError(f"only primary key tables have a CREATE statement, not {self.model.name}")
        listed = lambda names: ", ".join(map(quote_ident, names))
        out = f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{quote_ident(self.database)}.{quote_ident(self.name)} (\n"
        out += ",\n".join(c.ddl() for c in self.columns)
        out += f"\n) PRIMARY KEY ({listed(self.keys)})\nDISTRIBUTED BY HASH ({listed(self.distribution or self.keys)})"
        if self.buckets is not None:
            out += f" BUCKETS {self.buckets}"
        if self.properties:
            out += "\nPROPERTIES (\n" + ",\n".join(f'"{k}" = "{v}"' for k, v in self.properties.items()) + "\n)"
        return out + ";"

    def add_columns_sql(self, added: Sequence[ColumnDef]) -> str:
        return f"ALTER TABLE {quote_ident(self.database)}.{quote_ident(self.name)} " + ", ".join(f"ADD COLUMN {c.ddl()}" for c in added) + ";"

    def drop_columns_sql(self, names: Sequence[str]) -> str:
        return f"ALTER TABLE {quote_ident(self.database)}.{quote_ident(self.name)} " + ", ".join(f"DROP COLUMN {quote_ident(n)}" for n in names) + ";"


def from_frame(database: str, name: str, schema: T.StructType, keys: Sequence[str] = (), **more) -> TableDef:
    """A table for rows of this schema, keyed and with the keys first if keys are named."""
    cols = tuple(ColumnDef(f.name, from_spark_type(f.dataType), f.nullable and f.name not in keys) for f in schema.fields)
    model = Model.PRIMARY_KEY if keys else Model.DUPLICATE_KEY
    table = TableDef(database, name, cols, model, tuple(keys), **more)
    return table.keys_first() if keys else table


@dataclass(frozen=True)
class SinkPlan:
    """What a check of a frame against a table found out."""

    upsert_delete: bool
    aligned: bool
    columns: tuple[str, ...]


def check_sink(table: TableDef, schema: T.StructType, keys: Sequence[str] = (), *, strict: bool = False) -> SinkPlan:
    """Whether rows of this schema can be loaded. Keys must name the same columns (letter case aside), each column must
    exist with a type that it accepts, and in strict mode the numbers of columns must be equal."""
    table_keys = table.keys if table.model is Model.PRIMARY_KEY else ()
    if keys and {k.lower() for k in keys} != {k.lower() for k in table_keys}:
        raise ValueError(f"primary keys differ: {sorted(keys)} and {sorted(table_keys)}")
    if strict and len(schema.fields) != len(table.columns):
        raise ValueError(f"{len(schema.fields)} columns for a table of {len(table.columns)}")
    for f in schema.fields:
        own = table.column(f.name)
        if own is None:
            raise ValueError(f"column {f.name} is not in {table.database}.{table.name}")
        if not accepts(own.kind, f.dataType):
            raise ValueError(f"column {f.name}: {own.kind} does not accept {f.dataType.simpleString()}")
    names = [f.name.lower() for f in schema.fields]
    aligned = names == [c.name.lower() for c in table.columns]
    return SinkPlan(bool(table_keys), aligned, tuple(f.name for f in schema.fields))


def load_columns(plan: SinkPlan, fmt: str, explicit: str | None = None, *, json_needs_op: bool = False) -> str | None:
    """The column list that goes with a load: as given; for CSV unless columns are aligned; for JSON only where the
    operation field is not found by itself. Upserting loads end with ``__op``."""
    if explicit:
        return explicit
    needed = not plan.aligned if fmt == "csv" else plan.upsert_delete and json_needs_op
    if not needed:
        return None
    names = [*plan.columns, *(["__op"] if plan.upsert_delete else [])]
    return ",".join(map(quote_ident, names))


def mapping_exprs(columns: str) -> list[str]:
    """A column list with ``alias=expression`` parts as expressions for ``selectExpr``. Sources of expressions that are
    only listed as input stay out of the result."""
    parts, depth, start = [], 0, 0
    for k, c in enumerate(columns + ","):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append(columns[start:k].strip())
            start = k + 1
    named = [re.match(r"`?([^`=\s]+)`?\s*=(?!=)\s*(.+)$", p, re.S) for p in parts]
    used = " ".join(m[2] for m in named if m)
    out = []
    for p, m in zip(parts, named, strict=True):
        if m:
            out.append(f"{m[2]} AS `{m[1]}`")
        elif not re.search(rf"\b{re.escape(p.strip('`'))}\b", used):
            out.append(quote_ident(p))
    return out
