import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import Catalog
from millrace.cli import pairs, statements
from millrace.operators import changelog, keyed, transactions
from millrace.operators.lookup import CachedDimension
from millrace.plans.tables import ColumnDef, Model, TableDef, check_sink, from_frame, load_columns, mapping_exprs
from millrace.sources import python_source, records, scan
from millrace.sources.options import CatalogOptions, ScanOptions, SinkOptions, all_or_none


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_and_delete(spark):
    log = [("+I", 1, 1.0, "row1", 1), ("+I", 2, 2.0, "row2", 2), ("+U", 1, 3.0, "row3", 3), ("+U", 3, 3.0, "row3", 4), ("-D", 2, 2.0, "row2", 5)]
    df = spark.createDataFrame(log, "_kind string, c0 int, c1 double, c2 string, seq int")
    changes = changelog.keep_kinds(df).withColumn("__op", changelog.op_of(F.col("_kind"))).drop("_kind")
    assert rows(keyed.apply_changes(changes, ["c0"], ["seq"]).drop("seq")) == [(1, 3.0, "row3"), (3, 3.0, "row3")]


def test_key_change_needs_update_before(spark):
    log = [("+I", 1, 1), ("-U", 1, 2), ("+U", 2, 2)]
    df = spark.createDataFrame(log, "_kind string, c0 int, seq int")
    apply = lambda ignore: rows(
        keyed.apply_changes(
            changelog.keep_kinds(df, ignore_update_before=ignore).withColumn("__op", changelog.op_of(F.col("_kind"))).drop("_kind"), ["c0"], ["seq"]
        ).select("c0")
    )
    assert apply(False) == [(2,)] and apply(True) == [(1,), (2,)]


def test_partial_update(spark):
    base = spark.createDataFrame([(1, 1.0, "1"), (2, 2.0, "2")], "c0 int, c1 double, c2 string")
    delta = spark.createDataFrame([(1, "1", 1), (2, "22", 0), (3, "3", 0)], "c0 int, c2 string, __op int")
    assert rows(keyed.partial_update(base, delta, ["c0"])) == [(2, 2.0, "22"), (3, None, "3")]
    again = spark.createDataFrame([(1, "x", 1, 1), (1, "back", 0, 2), (2, "a", 0, 1), (2, None, 0, 2)], "c0 int, c2 string, __op int, seq int")
    assert sorted(map(str, rows(keyed.partial_update(base, again, ["c0"], sequence=["seq"])))) == ["(1, None, 'back')", "(2, 2.0, None)"]
    with pytest.raises(ValueError):
        keyed.partial_update(base, delta.withColumn("zz", F.lit(1)), ["c0"])


def test_conditional_update(spark):
    base = spark.createDataFrame([(1, "first", 100), (2, "first", 100)], "id int, name string, score int")
    delta = spark.createDataFrame([(1, "second", 99), (2, "second", 101), (2, "third", 101), (3, "new", 1)], "id int, name string, score int").withColumn("seq", F.monotonically_increasing_id())
    assert rows(keyed.conditional_update(base, delta, ["id"], "score", sequence=["seq"])) == [(1, "first", 100), (2, "third", 101), (3, "new", 1)]


def test_bitmaps_merge(spark):
    visits = spark.createDataFrame([(1, 13), (1, 23), (1, 33), (1, 13), (2, 33), (2, 33), (2, None)], "page int, visitor int")
    parts = [keyed.bitmap_state(visits.where(f"visitor % 20 {c} 3"), ["page"], "visitor") for c in ("=", "<>")]
    assert rows(keyed.bitmap_count(parts[0].unionByName(parts[1]), ["page"])) == [(1, 3), (2, 1)]


def test_quality_gate(spark):
    df = spark.range(10)
    assert keyed.quality_gate(df, F.col("id") > 1, 0.2).count() == 8
    with pytest.raises(ValueError, match="too many filtered rows"):
        keyed.quality_gate(df, F.col("id") > 2, 0.2)


def test_transactions(spark):
    events = [(0, 1, "DATA"), (0, 2, "TXN_BEGIN"), (0, 3, "DATA"), (0, 4, "TXN_BEGIN"), (0, 5, "DATA"), (0, 6, "DATA"), (0, 7, "TXN_END"), (1, 1, "TXN_BEGIN"), (1, 2, "DATA")]
    df = spark.createDataFrame(events, "p int, seq int, type string")
    assert [(r.p, r.seq, r.transaction_end) for r in transactions.assemble(df, "p", ["seq"]).orderBy("seq").collect()] == [(0, 5, False), (0, 6, True)]
    assert rows(transactions.partitions_without_end(df, "p", "type")) == [(1,)]
    with pytest.raises(Exception, match="source partition"):
        transactions.check_partitions(spark.createDataFrame([(-1,)], "source_partition int")).collect()
    with pytest.raises(ValueError):
        transactions.check_one_database(["a", "b"])
    assert [transactions.flush_interval_ms(x) for x in (100, 5_000, 60_000)] == [100, 500, 1_000]


def test_splits():
    by_host = {"h0": [1, 2, 3, 4], "h1": [5, 6, 7], "h2": [8, 9, 10]}
    for n in range(1, 21):
        got = scan.assign_splits(n, by_host)
        assert len(got) == n and sorted(s for task in got for _, own in task for s in own) == list(range(1, 11))
        assert all(s in by_host[h] for task in got for h, own in task for s in own)
    assert scan.assign_splits(3, by_host) == [[(h, s)] for h, s in by_host.items()]
    chosen = scan.choose_hosts({1: ["a", "b"], 2: ["a", "b"], 3: ["a", "b"], 4: ["b", "a"]})
    assert sorted(map(len, chosen.values())) == [2, 2]
    assert scan.remote_query("d", "t", ["a"], [])[0] == "select `a` from `d`.`t`"


def test_scan_errors(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    with pytest.raises(ValueError, match="column not found"):
        scan.scan_text(df, ScanOptions(columns="zz"))
    with pytest.raises(Exception, match="null for a non-nullable column"):
        scan.not_null(df, ["b"]).collect()


def test_options():
    o = SinkOptions.parse({"sink.semantic": "exactly-once", "sink.buffer-flush.max-bytes": "100m", "sink.properties.format": "json", "sink.properties.Partial_Update": "true", "sink.properties.x": "1"})
    assert (o.semantic, o.flush_max_bytes, o.format, o.partial_update, o.properties) == ("exactly-once", 100 << 20, "json", True, {"x": "1"})
    for bad in ({"sink.max-retries": "1001"}, {"sink.semantic": "x"}, {"sink.buffer-flush.max-rows": "10"}, {"sink.semantic": "exactly-once", "sink.transaction.multi-table.enabled": "true"}):
        with pytest.raises(ValueError):
            SinkOptions.parse(bad)
    with pytest.raises(ValueError):
        all_or_none({"a": "1"}, ("a", "b"))
    c = CatalogOptions.parse({"default-database": "d", "sink.label-prefix": "p", "scan.columns": "a", "table.num-buckets": "4", "table.properties.r": "1"})
    assert c.sink_for("db", "t").label_prefix == "p_db_t" and c.table == {"r": "1"} and c.buckets == 4


def test_table_definitions():
    t = TableDef("d", "t", (ColumnDef("v", "DECIMAL(10,2)"), ColumnDef("id", "INT", False), ColumnDef("at", "DATETIME", False, "CURRENT_TIMESTAMP", "when")), Model.PRIMARY_KEY, ("id",), buckets=3, properties={"a": "b"})
    sql = t.keys_first().create_sql(if_not_exists=True)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS `d`.`t` (\n`id` INT NOT NULL,\n`v` DECIMAL(10,2) NULL,\n`at` DATETIME NOT NULL DEFAULT CURRENT_TIMESTAMP COMMENT \"when\"\n)")
    assert sql.endswith('PRIMARY KEY (`id`)\nDISTRIBUTED BY HASH (`id`) BUCKETS 3\nPROPERTIES (\n"a" = "b"\n);')
    schema = T.StructType().add("ID", T.IntegerType()).add("v", T.DecimalType(10, 2))
    plan = check_sink(t, schema, ["id"])
    assert plan.upsert_delete and not plan.aligned and load_columns(plan, "csv") == "`ID`,`v`,`__op`" and load_columns(plan, "json") is None
    for bad in (lambda: check_sink(t, schema, ["v"]), lambda: check_sink(t, schema, ["id"], strict=True), lambda: check_sink(t, T.StructType().add("id", T.LongType()), ["id"])):
        with pytest.raises(ValueError):
            bad()
    assert mapping_exprs("page, visitor, seen=to_bitmap(visitor, 1)") == ["`page`", "to_bitmap(visitor, 1) AS `seen`"]
    assert "".join(from_frame("d", "t", schema, ["v"]).columns[0].name) == "v"


def test_catalog(spark):
    cat = Catalog(spark, CatalogOptions(buckets=2))
    cat.create_database("shop")
    t = TableDef("shop", "goods", (ColumnDef("name", "VARCHAR(20)"), ColumnDef("id", "INT", False)), Model.PRIMARY_KEY, ("id",), comment="it's")
    cat.create_table(t)
    try:
        assert cat.table_exists("shop", "goods") and "shop" in cat.list_databases() and cat.list_tables("shop") == ["goods"]
        got = cat.get_table("shop", "goods")
        assert [c.name for c in got.columns] == ["id", "name"] and got.keys == ("id",) and got.model is Model.PRIMARY_KEY and got.buckets == 2
        spark.sql("insert into shop.goods values (1, 'a')")
        cat.add_columns("shop", "goods", [ColumnDef("price", "DOUBLE")])
        assert rows(cat.table("shop", "goods")) == [(1, "a", None)]
        cat.drop_columns("shop", "goods", ["name"])
        assert cat.table("shop", "goods").columns == ["id", "price"]
        for bad in (lambda: cat.create_table(t), lambda: cat.drop_columns("shop", "goods", ["id"]), lambda: cat.get_table("shop", "no"), lambda: cat.add_columns("shop", "goods", [ColumnDef("ID", "INT")])):
            with pytest.raises(ValueError):
                bad()
        with pytest.raises(NotImplementedError):
            cat.rename_table("a", "b")
    finally:
        cat.drop_table("shop", "goods")
        spark.sql("drop database shop")


def test_python_source(spark, sf):
    python_source.register(spark)
    df = spark.read.format("millrace").option("path", f"{sf}/orders.parquet").load()
    want = spark.read.parquet(f"{sf}/orders.parquet")
    assert df.schema == want.schema
    cond = "o_orderstatus = 'F' and o_totalprice > 1000 and o_orderkey in (1, 2, 3, 5, 8) and o_orderpriority like '%T%'"
    assert rows(df.where(cond)) == rows(want.where(cond))


def test_lookup_cache_and_cli():
    clock = iter([0.0, 1.0, 5.0])
    loads = []
    dim = CachedDimension(lambda: loads.append(1) or len(loads), 5_000, lambda: next(clock))
    assert [dim.get(), dim.get(), dim.get()] == [1, 1, 2]
    assert pairs(["a=1", "password="]) == {"a": "1", "password": ""} and pairs(["a=1", "b="]) is None
    assert statements("select 1;\nselect ';' ;\n\n select 3") == ["select 1", "select ';'", "select 3"]


def test_text_records(spark):
    schema = T.StructType().add("a", T.IntegerType()).add("b", T.BooleanType()).add("c", T.StringType())
    lines = spark.createDataFrame([("1|1|x",), ("\\N|0",), ("bad|1|y",)], "value string")
    got = records.from_csv_lines(lines, schema, "|", strict=False).collect()
    assert [tuple(r) for r in got] == [(1, True, "x"), (None, False, None), (None, True, "y")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        records.from_csv_lines(lines, schema, "|").collect()


def test_partial_updates_in_sequence(spark):
    """Several changes of a key with deletes between them and absent fields, against a fold over each key."""
    rng = random.Random(5)
    base = [(k, k, -k) for k in range(20)]
    delta = [(rng.randrange(40), s, rng.choice([None, s]), rng.choice([None, -s]), int(rng.random() < 0.3), rng.sample(["a", "b"], rng.randrange(3))) for s in range(200)]
    want = {k: (a, b) for k, a, b in base}
    for k, _, a, b, op, present in delta:
        if op:
            want.pop(k, None)
        else:
            old = want.get(k, (None, None))
            want[k] = (a if "a" in present else old[0], b if "b" in present else old[1])
    rng.shuffle(delta)
    frame = spark.createDataFrame(delta, "k int, seq int, a int, b int, __op int, present array<string>")
    got = keyed.partial_update(spark.createDataFrame(base, "k int, a int, b int"), frame, ["k"], sequence=["seq"], present="present")
    assert {r.k: (r.a, r.b) for r in got.collect()} == want
