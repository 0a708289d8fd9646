"""Type maps between remote column types, MySQL column types and Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MAX_VARCHAR = 1_048_576
MAX_STRING_BYTES = 65_533

#: Remote types without parameters.
_PLAIN = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "LARGEINT": T.StringType(),
    "BIGINT UNSIGNED": T.StringType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
}


def to_spark_type(remote: str, size: int | None = None, digits: int | None = None) -> T.DataType:
    """The Spark type of a remote column. A TINYINT without a size is how metadata shows a BOOLEAN; 128-bit integers
    are strings; arrays, maps and structs are spelled ``ARRAY<..>``, ``MAP<..>``, ``STRUCT<a ..>``."""
    name = re.sub(r"\s+", " ", remote.strip()).upper()
    nested = re.fullmatch(r"(ARRAY|MAP|STRUCT)\s*<(.*)>", remote.strip(), re.I | re.S)
    if nested:
        inner = _split_top(nested[2])
        if nested[1].upper() == "ARRAY":
            return T.ArrayType(parse_type(inner[0]))
        if nested[1].upper() == "MAP":
            return T.MapType(parse_type(inner[0]), parse_type(inner[1]))
        pairs = [p.strip().replace(":", " ", 1).split(None, 1) for p in inner]
        return T.StructType([T.StructField(n.strip("`"), parse_type(t)) for n, t in pairs])
    if name == "TINYINT" and size is None:
        return T.BooleanType()
    if name in _PLAIN:
        return _PLAIN[name]
    if name in ("DECIMAL", "DECIMALV2", "DECIMAL32", "DECIMAL64", "DECIMAL128"):
        if size is None or digits is None:
            raise ValueError(f"{name} needs a precision and a scale")
        return T.DecimalType(size, digits)
    if name in ("CHAR", "VARCHAR"):
        if size is None:
            raise ValueError(f"{name} needs a length")
        return T.CharType(size) if name == "CHAR" else T.VarcharType(size)
    raise TypeError(f"unsupported remote type {remote}")


def parse_type(text: str) -> T.DataType:
    """``to_spark_type`` of a type as DDL spells it, such as ``decimal(10,2)`` or ``array<int>``."""
    m = re.fullmatch(r"\s*([A-Za-z][A-Za-z0-9 ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", text)
    if not m:
        return to_spark_type(text)
    size = int(m[2]) if m[2] else None
    if m[1].upper() == "TINYINT":
        size = size or 4
    return to_spark_type(m[1], size, int(m[3] or 0) if m[2] else None)


def _split_top(text: str) -> list[str]:
    """Comma-separated parts outside of angle and round brackets."""
    depth, out, start = 0, [], 0
    for k, c in enumerate(text):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(text[start:k])
            start = k + 1
    return [*out, text[start:]]


def from_spark_type(kind: T.DataType) -> str:
    """The remote type of a Spark column; nested types have none in tables that the catalog creates."""
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision}, {kind.scale})"
    if isinstance(kind, T.CharType):
        return f"CHAR({kind.length})"
    if isinstance(kind, T.VarcharType):
        return f"VARCHAR({min(kind.length, MAX_VARCHAR)})"
    if isinstance(kind, T.StringType):
        return f"VARCHAR({MAX_VARCHAR})"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    for name in ("BOOLEAN", "TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DATE"):
        if kind == _PLAIN[name]:
            return name
    raise TypeError(f"unsupported Spark type {kind.simpleString()}")


#: MySQL type names by the remote type they become. Unsigned integers take the next wider type.
_INTEGERS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "LARGEINT")
_MYSQL_INTEGER = {"TINYINT": 0, "SMALLINT": 1, "INT": 2, "MEDIUMINT": 2, "YEAR": 2, "BIGINT": 3}
_MYSQL_STRING = (
    "TINYTEXT TEXT MEDIUMTEXT LONGTEXT ENUM TIME TINYBLOB BLOB MEDIUMBLOB LONGBLOB BINARY VARBINARY".split()
)


def mysql_to_remote(mysql: str, length: int | None = None, scale: int | None = None) -> str:
    """The remote type of a MySQL column. Text lengths count characters there and bytes here, hence the factor 3."""
    name = re.sub(r"\s+", " ", mysql.strip()).upper()
    base = re.sub(r" UNSIGNED( ZEROFILL)?$", "", name)
    unsigned = base != name
    if base in _MYSQL_INTEGER and not (unsigned and base == "YEAR"):
        return _INTEGERS[_MYSQL_INTEGER[base] + unsigned]
    if base in ("BIT", "BOOLEAN", "BOOL") and not unsigned:
        return "BOOLEAN"
    if base == "FLOAT":
        return "FLOAT"
    if base in ("REAL", "DOUBLE", "DOUBLE PRECISION"):
        return "DOUBLE"
    if base in ("NUMERIC", "FIXED", "DECIMAL"):
        fits = length is not None and length <= 38
        return f"DECIMAL({length},{max(scale or 0, 0)})" if fits else "STRING"
    if not unsigned:
        if base == "DATE":
            return "DATEV2"
        if base in ("DATETIME", "TIMESTAMP"):
            return "DATETIME"
        if base in ("CHAR", "VARCHAR") and length is None:
            raise ValueError(f"{base} needs a length")
        if base == "CHAR":
            return f"CHAR({length})"
        if base == "VARCHAR":
            return "STRING" if length * 3 > MAX_STRING_BYTES else f"VARCHAR({length * 3})"
        if base in _MYSQL_STRING:
            return "STRING"
        if base == "JSON":
            return "JSONB"
    raise TypeError(f"unsupported MySQL type {mysql}")


#: Spark types that a remote column of a sink table accepts. Remote types not listed accept anything.
ACCEPTS = {
    "bigint": ("long", "integer", "binary"),
    "largeint": ("decimal", "long", "integer", "binary"),
    "char": ("char", "varchar", "string"),
    "date": ("date", "varchar", "string"),
    "datetime": ("timestamp", "timestamp_ntz", "varchar", "string"),
    "decimal": ("decimal", "long", "integer", "double", "float"),
    "double": ("double", "long", "integer"),
    "float": ("float", "integer"),
    "int": ("integer", "binary"),
    "tinyint": ("byte", "integer", "binary", "boolean"),
    "smallint": ("short", "integer", "binary"),
    "varchar": ("varchar", "string", "array", "map", "struct"),
    "string": ("char", "varchar", "string", "array", "map", "struct"),
}


def accepts(remote: str, kind: T.DataType) -> bool:
    allowed = ACCEPTS.get(re.sub(r"\(.*", "", remote).strip().lower())
    return allowed is None or kind.typeName() in allowed


def arrow_to_spark(arrow: str) -> T.DataType:
    """The Spark type of an Arrow minor type name."""
    known = {
        "BIT": T.BooleanType(), "TINYINT": T.ByteType(), "SMALLINT": T.ShortType(), "INT": T.IntegerType(),
        "BIGINT": T.LongType(), "FLOAT4": T.FloatType(), "FLOAT8": T.DoubleType(), "VARCHAR": T.StringType(),
        "DATEDAY": T.DateType(), "VARBINARY": T.BinaryType(),
    }
    if arrow.upper() not in known:
        raise TypeError(f"unsupported Arrow type {arrow}")
    return known[arrow.upper()]
