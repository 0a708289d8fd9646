"""What users plug into loads: how a record becomes a row of a table, and how it names its table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.encoding import NULL
from millrace.operators.transactions import dispatch
from millrace.plans.tables import TableDef
from millrace.sources.options import SinkOptions

Split = Callable[[DataFrame, TableDef], DataFrame]


def with_operation(table: TableDef) -> T.StructType:
    """The table's columns and the operation, which is the last one."""
    return T.StructType([*table.schema.fields, T.StructField("__op", T.IntegerType())])


def build_rows(columns: Mapping[str, Column], operation: Column | None = None) -> Split:
    """Rows by one expression a column, cast to the table's types; columns without one are null."""
    known = {name.lower(): c for name, c in columns.items()}

    def split(batch: DataFrame, table: TableDef) -> DataFrame:
        if unknown := set(known) - {c.name.lower() for c in table.columns}:
            raise ValueError(f"columns not in {table.name}: {sorted(unknown)}")
        own = [known.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        return batch.select(*own, (F.lit(0) if operation is None else operation).cast("int").alias("__op"))

    return split


def build_batches(build: Callable[[pd.DataFrame], pd.DataFrame]) -> Split:
    """Rows by a function on Arrow batches, where expressions cannot say it. It returns the columns of the table, and
    may return ``__op``; without it all rows are upserts."""

    def split(batch: DataFrame, table: TableDef) -> DataFrame:
        schema = with_operation(table)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = build(frame)
                yield (out if "__op" in out else out.assign(__op=0))[schema.fieldNames()]

        return batch.mapInPandas(run, schema)

    return split


def split_payloads(options: SinkOptions, serialize: Callable[[DataFrame], DataFrame] | None = None) -> Split:
    """Rows of records ``db, tbl, payload``, each payload one CSV or JSON row with the table's columns and perhaps the
    operation after them. ``serialize`` makes such records of other ones. Records that name no table or have no payload
    are left out; fields that do not parse are null, and in strict mode fail the load."""

    def split(batch: DataFrame, table: TableDef) -> DataFrame:
        records = dispatch(batch if serialize is None else serialize(batch))
        own = records.where((F.col("db") == table.database) & (F.col("tbl") == table.name))
        fields = with_operation(table).fields
        if options.format == "json":
            texts = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in fields])
            own = own.select(F.from_json("payload", texts, {"mode": "FAILFAST" if options.strict_mode else "PERMISSIVE"}).alias("r"))
            cells = [F.col("r")[f.name] for f in fields]
        else:
            # lines have neither quotes nor escapes
            own = own.select(F.split("payload", re.escape(options.column_separator), -1).alias("r"))
            cells = [F.nullif(F.get("r", F.lit(k)), F.lit(NULL)) for k in range(len(fields))]
        values = [_typed(c, f.dataType, options) for c, f in zip(cells, fields, strict=True)]
        values[-1] = F.coalesce(values[-1], F.lit(0))
        return own.select(*[v.alias(f.name) for v, f in zip(values, fields, strict=True)])

    return split


def _typed(cell: Column, kind: T.DataType, options: SinkOptions) -> Column:
    """A parsed JSON value or a CSV cell as ``kind``; booleans come as words or as 1 and 0."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return cell if options.format == "json" else F.from_json(cell, kind)
    return cell.cast(kind) if options.strict_mode else cell.try_cast(kind)
