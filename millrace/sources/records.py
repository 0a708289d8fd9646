"""Record inputs that are text already: delimited lines and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.encoding import NULL


def from_csv_lines(lines: DataFrame, schema: T.StructType, separator: str = "\t", column: str = "value", *, strict: bool = True) -> DataFrame:
    """Columns of delimited lines as loads read them: no quotes, ``\\N`` is null, missing cells are null. A cell that
    does not convert is an error in strict mode and null otherwise."""
    # the separator is a literal, so a pattern quotes it
    cells = F.split(F.col(column), "\\Q" + separator.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)
    return lines.select(*[_cell(F.get(cells, F.lit(k)), f, strict) for k, f in enumerate(schema.fields)])


def _cell(c: Column, f: T.StructField, strict: bool) -> Column:
    text = F.when(c != NULL, c)
    if isinstance(f.dataType, T.BooleanType):
        text = F.when(text.isin("1", "0"), (text == "1").cast("string")).otherwise(text)
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(text, f.dataType).alias(f.name)
    return (text.cast(f.dataType) if strict else text.try_cast(f.dataType)).alias(f.name)


def from_json_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Columns of JSON objects, one a line; absent fields are null."""
    return lines.select(F.from_json(column, schema).alias("r")).select("r.*")


def json_presence(lines: DataFrame, column: str = "value") -> DataFrame:
    """``lines`` with ``present``, the names that each JSON object has: a field that is there with null is not absent."""
    return lines.withColumn("present", F.json_object_keys(column))
