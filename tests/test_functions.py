import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import encoding, text, types
from millrace.plans.predicates import Call, Cast, Field, Value, push_down, render


def test_delimiters():
    assert text.parse_delimiter("\\x0102") == "\x01\x02" and text.parse_delimiter("0x7c") == "|"
    assert text.parse_delimiter("||") == "||" and text.parse_delimiter("", "\t") == "\t"
    assert text.parse_delimiter("0x7c", zero_x=False) == "0x7c"
    for bad in ("\\x", "\\x0", "\\x0g", ""):
        with pytest.raises(ValueError):
            text.parse_delimiter(bad)


def test_sanitize(spark):
    """Own log lines: rows and quoted values go, what names the error stays."""
    logs = [
        "Reason: wrong type in field 3. Row: [17, pear]\nReason: too short. Row: {\"a\": 1}",
        "Error: Value 'kiwi' is invalid.\nError: Value \"plum\" is invalid.",
        "Row: [9]",
    ]
    df = spark.createDataFrame(list(enumerate(logs)), "id int, log string")
    out = {r.id: r.c for r in df.select("id", text.sanitize_error_log(F.col("log")).alias("c")).collect()}
    assert [x.strip() for x in out[0].split("\n")] == ["Reason: wrong type in field 3.", "Reason: too short."]
    assert not any(w in out[1] for w in ("kiwi", "plum")) and out[1].count("invalid") == 2
    assert out[2] == text.REDACTED


def test_helpers(spark):
    assert text.basic_auth("a", "b") == "Basic YTpi" and text.quote_ident(" `x` ") == "`x`"
    r = spark.range(1).select(
        text.bytes_to_long(F.lit(bytes([1, 0]))).alias("n"), text.bytes_to_long(F.lit(b"")).alias("z"),
        text.bytes_to_long(F.lit(b"\xff" * 8)).alias("m"), text.clear_brackets(F.lit("a(b(c)d)e(f)")).alias("s"),
        text.clear_brackets(F.lit("x" + "(" * 40 + "deep" + ")" * 40 + "y(open")).alias("d"),
    ).first()
    assert (r.n, r.z, r.m, r.s, r.d) == (256, 0, -1, "ae", "xy(open")


def test_bytes_are_not_read_as_text(spark):
    numbers = [0xE000, 0xC3A9, 0xF09F_9880, 0xE282_AC00_0000_0000 - (1 << 64), -1, (1 << 63) - 1, 0]
    raw = [n.to_bytes(8, "big", signed=True) for n in numbers] + [b"\x01\x02" + b"\xe0" * 8, b"\xe0\x01"]
    want = [*numbers, int.from_bytes(b"\xe0" * 8, "big", signed=True), 0xE001]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, b binary").select("i", text.bytes_to_long(F.col("b")).alias("n"))
    assert [r.n for r in df.orderBy("i").collect()] == want


def test_types():
    assert types.to_spark_type("tinyint") == T.BooleanType() and types.to_spark_type("TINYINT", 4) == T.ByteType()
    assert types.to_spark_type("LARGEINT") == T.StringType() and types.to_spark_type("decimal", 10, 2) == T.DecimalType(10, 2)
    assert types.to_spark_type("ARRAY<MAP<INT,DECIMAL(38,10)>>") == T.ArrayType(T.MapType(T.IntegerType(), T.DecimalType(38, 10)))
    assert types.to_spark_type("STRUCT<id INT, name varchar(5)>")["name"].dataType == T.VarcharType(5)
    assert types.from_spark_type(T.VarcharType(2_000_000)) == "VARCHAR(1048576)"
    assert types.from_spark_type(T.TimestampNTZType()) == types.from_spark_type(T.TimestampType()) == "DATETIME"
    for bad in (lambda: types.to_spark_type("HLL"), lambda: types.from_spark_type(T.ArrayType(T.LongType())), lambda: types.mysql_to_remote("geometry")):
        with pytest.raises(TypeError):
            bad()
    assert types.mysql_to_remote("varchar", 21845) == "STRING" and types.mysql_to_remote("varchar", 21844) == "VARCHAR(65532)"
    assert types.mysql_to_remote("smallint unsigned zerofill") == "INT" and types.mysql_to_remote("bit") == "BOOLEAN"
    assert types.accepts("bigint", T.IntegerType()) and not types.accepts("int", T.LongType()) and types.accepts("hll", T.LongType())


def test_predicate_texts():
    c1, c3 = Field("c1"), Field("c3", boolean=True)
    ops = [Call(o, (c1, Value(1))) for o in ("eq", "ne", "gt", "ge", "lt", "le")]
    assert push_down(ops)[0] == "(c1 = 1) and (c1 <> 1) and (c1 > 1) and (c1 >= 1) and (c1 < 1) and (c1 <= 1)"
    assert push_down([c3])[0] == "(c3 = true)"
    assert render(Call("or", (ops[0], Call("eq", (c3, Value(True)))))) == "((c1 = 1) or (c3 = true))"
    assert render(Call("eq", (Field("c5"), Value("2022-1-22 00:00:00")))) == "(c5 = '2022-1-22 00:00:00')"
    assert render(Call("eq", (Field("d"), Value(dt.date(2022, 1, 2))))) == "(d = '2022-01-02')"
    assert render(Call("is_null", (c1,))) == "(c1 is null)" and render(Call("not", (c3,))) == "(c3 = false)"
    like = Call("like", (c1, Value("a%")))
    both = Call("or", (ops[0], like))
    text_, accepted, rest = push_down([ops[0], like, both])
    assert text_ == "(c1 = 1)" and accepted == [ops[0]] and rest == [like, both]
    assert render(Call("eq", (Cast(c1, "bigint"), Value(1)))) == "(cast(c1 as bigint) = 1)"


def test_encoding(spark):
    df = spark.sql(
        "select 1 as i, true as b, date'2024-01-02' as d, timestamp_ntz'2024-01-02 03:04:05.123456' as t, cast(1.50 as decimal(10,2)) as m,"
        " array(named_struct('k', 1, 'd', date'2024-01-02')) as a, map(date'2024-01-02', cast(2.5 as decimal(3,1))) as p, cast(null as string) as n, X'0100' as x"
    )
    line = df.select(encoding.csv_line(df, separator="|").alias("v")).first().v
    assert line == '1|1|2024-01-02|2024-01-02 03:04:05.123456|1.50|["{\\"k\\":1,\\"d\\":\\"2024-01-02\\"}"]|{"2024-01-02":"2.5"}|\\N|256'
    assert '"n"' not in df.select(encoding.json_line(df).alias("v")).first().v
    good = spark.range(1).select(encoding.parse_datetime(F.lit("2024-01-02 03:04:05")).alias("t")).first().t
    assert good == dt.datetime(2024, 1, 2, 3, 4, 5)
    with pytest.raises(Exception, match="not a datetime"):
        spark.range(1).select(encoding.parse_datetime(F.lit("2024-01-02 03:04:05.123"))).collect()
