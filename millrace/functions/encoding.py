"""Row encoding for loads: CSV and JSON lines, and the values inside them. Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import bytes_to_long

NULL = "\\N"


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def parse_date(c: Column) -> Column:
    return F.to_date(c, "yyyy-MM-dd")


def parse_datetime(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with either no fraction or exactly six digits; anything else is an error in ANSI mode."""
    fits = c.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{6})?$")
    bad = F.raise_error(F.concat(F.lit("not a datetime: "), c)).cast("timestamp_ntz")
    return F.when(c.isNull() | fits, F.to_timestamp_ntz(c)).otherwise(bad)


def plain(c: Column, kind: T.DataType) -> Column:
    """The value as it goes into a load: booleans as 1 and 0, dates and times as text, binaries as numbers, nested
    values converted throughout; structs inside arrays become JSON texts."""
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_text(c)
    if isinstance(kind, T.BinaryType):
        return bytes_to_long(c)
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, T.StructType):
            return F.transform(c, lambda x: F.to_json(plain(x, inner)))
        return F.transform(c, lambda x: plain(x, inner))
    if isinstance(kind, T.MapType):
        keyed = F.transform_keys(c, lambda k, _: plain(k, kind.keyType).cast("string"))
        return F.transform_values(keyed, lambda _, v: plain(v, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def text_value(c: Column, kind: T.DataType) -> Column:
    """``plain`` as one text: nested values as JSON."""
    value = plain(c, kind)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def csv_line(df: DataFrame, columns: Sequence[str] | None = None, separator: str = "\t") -> Column:
    """One line of the columns: the separator between them, ``\\N`` for null, neither quotes nor escapes."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.coalesce(text_value(F.col(f"`{c}`"), kinds[c]), F.lit(NULL)) for c in columns or df.columns]
    return F.concat_ws(separator, *cells)


def json_line(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One JSON object of the columns; null fields are left out."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[plain(F.col(f"`{c}`"), kinds[c]).alias(c) for c in columns or df.columns]))


def serialize(df: DataFrame, fmt: str = "csv", *, separator: str = "\t", op: Column | None = None) -> DataFrame:
    """``df`` as a frame of one column ``value``. With ``op`` the change operation is a last field ``__op``."""
    if fmt not in ("csv", "json"):
        raise ValueError("format is csv or json")
    rows = df.withColumn("__op", op) if op is not None else df
    return rows.select((csv_line(rows, separator=separator) if fmt == "csv" else json_line(rows)).alias("value"))
