"""Change streams: row kinds, operations, envelope decoding, routing, and schema changes inside them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPSERT, DELETE = 0, 1


def op_of(kind: Column) -> Column:
    """The operation of a row kind: +I and +U upsert, -U and -D delete; others are an error."""
    bad = F.raise_error(F.concat(F.lit("unknown row kind "), F.coalesce(kind, F.lit("null")))).cast("int")
    return F.when(kind.isin("+I", "+U"), UPSERT).when(kind.isin("-U", "-D"), DELETE).otherwise(bad)


def keep_kinds(df: DataFrame, *, kind: str = "_kind", keyed: bool = True, ignore_update_before: bool = True) -> DataFrame:
    """Rows that a load takes: no -U without keys or where they are ignored, no -D without keys."""
    c = F.col(kind)
    if not keyed:
        return df.where(~c.isin("-U", "-D"))
    return df.where(c != "-U") if ignore_update_before else df


def envelope_schema(row: T.StructType) -> T.StructType:
    source = T.StructType([T.StructField(n, T.StringType()) for n in ("db", "schema", "table", "file")])
    for n in ("ts_ms", "pos", "row"):
        source = source.add(n, T.LongType())
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("source", source),
            T.StructField("historyRecord", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


#: Name of the column that orders the changes of a stream.
SEQUENCE = "__seq"


def sequence_of(arrival: Column) -> Column:
    """What orders decoded records ``r``: the source's time, its log file, place and row in it, then arrival."""
    time = F.coalesce(F.col("r.source.ts_ms"), F.col("r.ts_ms"))
    places = [F.col(f"r.source.{n}").alias(n) for n in ("file", "pos", "row")]
    return F.struct(time.alias("ts_ms"), *places, arrival.cast("long").alias("arrival"))


def decode_envelopes(records: DataFrame, row: T.StructType, column: str = "value", *, arrival: Column | None = None) -> DataFrame:
    """Rows of change envelopes: the state after for r, c and u with ``__op`` "0", the state before for d with "1".

    Values are texts, as loads take them. Records with another operation or none are dropped. With ``arrival``, a number
    that grows with the stream, rows have ``__seq``, by which a later change of a key is told from an earlier one.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in row.fields])
    parsed = records.select(F.from_json(column, envelope_schema(texts)).alias("r"), *([] if arrival is None else [arrival.alias("_arrival")]))
    op = F.col("r.op")
    rows = parsed.where(op.isin("r", "c", "u", "d"))
    chosen = F.when(op == "d", F.col("r.before")).otherwise(F.col("r.after"))
    seq = [] if arrival is None else [sequence_of(F.col("_arrival")).alias(SEQUENCE)]
    return rows.select(chosen.alias("v"), F.when(op == "d", "1").otherwise("0").alias("__op"), *seq).select(
        *[F.col(f"v.`{f.name}`") for f in row.fields], "__op", *([] if arrival is None else [SEQUENCE])
    )


def typed(decoded: DataFrame, row: T.StructType) -> DataFrame:
    """Decoded texts cast to the row's types, with ``__op`` as a number."""
    seq = [SEQUENCE] if SEQUENCE in decoded.columns else []
    return decoded.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in row.fields], F.col("__op").cast("int"), *seq)


def source_of(column: str = "value") -> tuple[Column, Column]:
    """Database (its schema, where there is one) and table of an envelope."""
    path = lambda p: F.get_json_object(column, p)
    return F.coalesce(path("$.source.schema"), path("$.source.db")), path("$.source.table")


def full_match(pattern: str) -> str:
    return f"^(?:{pattern})$"


def table_wanted(name: Column, including: str | None = None, excluding: str | None = None) -> Column:
    """Whether a table takes part: whole-name patterns, exclusion wins."""
    take = name.rlike(full_match(including)) if including else F.lit(True)
    return take & ~name.rlike(full_match(excluding)) if excluding else take


def target_name(name: Column, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), name, F.lit(suffix))


def route(records: DataFrame, *, prefix: str = "", suffix: str = "", including: str | None = None, excluding: str | None = None, column: str = "value") -> DataFrame:
    """Envelopes with the ``db`` and ``tbl`` they go to; records of tables that take no part are dropped."""
    db, table = source_of(column)
    routed = records.withColumn("db", db).withColumn("_source_table", table)
    routed = routed.where(table_wanted(F.col("_source_table"), including, excluding))
    return routed.withColumn("tbl", target_name(F.col("_source_table"), prefix, suffix)).drop("_source_table")


def widen_type(kind: Column) -> Column:
    """A MySQL column type for a table that counts bytes: ``varchar(n)`` becomes ``varchar(min(3n, 65533))``."""
    n = F.regexp_extract(kind, r"(?i)varchar\(([1-9][0-9]*)\)", 1)
    wide = F.least(n.try_cast("long") * 3, F.lit(65_533))
    return F.when(F.coalesce(n, F.lit("")) == "", F.coalesce(kind, F.lit(""))).otherwise(F.format_string("varchar(%d)", wide))


def column_changes(records: DataFrame, *, column: str = "value", source_table: str | None = None) -> DataFrame:
    """Columns that records without an operation add or drop: ``db, tbl, action, column_name, column_type``, a row for
    each change of a statement. With ``source_table`` (``db.table``) other tables' statements are left out."""
    db, table = source_of(column)
    ddl = F.get_json_object(F.get_json_object(column, "$.historyRecord"), "$.ddl")
    rows = records.where(F.get_json_object(column, "$.op").isNull()).select(db.alias("db"), table.alias("tbl"), ddl.alias("ddl"))
    if source_table is not None:
        rows = rows.where(F.concat_ws(".", "db", "tbl") == source_table)
    body = F.regexp_extract("ddl", r"(?is)^\s*ALTER\s+TABLE\s+\S+\s+(.*?)[\s;]*$", 1)
    # parts end at commas outside of parentheses, as in DECIMAL(10, 2)
    part = F.explode(F.split(body, r",(?![^()]*\))")).alias("part")
    parts = rows.where(body != "").select("db", "tbl", part)
    kind = r"(?is)^\s*(ADD|DROP)\s+(?:COLUMN\s+)?(?!INDEX\b|KEY\b|PRIMARY\b|UNIQUE\b|CONSTRAINT\b|FOREIGN\b)`?([^\s`]+)`?(?:\s+([^\s(]+(?:\s*\([^)]*\))?))?"
    got = lambda k: F.regexp_extract("part", kind, k)
    action = F.lower(got(1))
    return parts.where(action != "").select(
        "db", "tbl", action.alias("action"), got(2).alias("column_name"), F.when(action == "add", widen_type(F.nullif(got(3), F.lit("")))).alias("column_type")
    )


def temporal_text(c: Column, kind: str) -> Column:
    """Dates and times as the change source writes them: timestamps in UTC+8 with microseconds."""
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind == "datetime":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if kind == "timestamp":
        return F.date_format(c + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if kind == "time":
        return F.date_format(c, "HH:mm:ss")
    raise ValueError(f"no text for {kind}")


def table_matches(names: Sequence[str], including: str | None, excluding: str | None) -> list[str]:
    """``table_wanted`` for names that are at hand."""
    full = lambda p, n: p is not None and re.fullmatch(p, n) is not None
    return [n for n in names if (including is None or full(including, n)) and not full(excluding, n)]
