import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from millrace.functions.encoding import serialize
from millrace.plans.tables import ColumnDef, Model, TableDef
from millrace.sources.options import SinkOptions
from millrace.cli import sink_options
from millrace.streaming import commit, hooks, sink
from millrace.streaming.assembler import assemble_stream
from millrace.streaming.cdc_sync import DatabaseSync, SourceColumn, SourceTable
from millrace.streaming.commit import COMMITTED, PREPARED, UNKNOWN, CommitLog, label, parse_label
from millrace.streaming.metrics import observed


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_labels_and_log(spark, tmp_path):
    assert label("p", "t", 2, 10) == "p-t-2-10" and parse_label("a-b-t-2-10") == ("a-b", "t", 2, 10)
    log = CommitLog(spark, f"file://{tmp_path}/store")
    assert log.read("d", "t") is None and log.state("x") == UNKNOWN
    a = log.stage(spark.range(3), "d", "t", "p-t-0-1")
    b = log.stage(spark.range(5), "d", "u", "p-t-0-1")
    assert log.state("p-t-0-1") == PREPARED and log.read("d", "t") is None
    assert log.publish("p-t-0-1", {"d.t": a, "d.u": b}) and not log.publish("p-t-0-1", {"d.t": a})
    assert (log.read("d", "t").count(), log.read("d", "u").count(), log.state("p-t-0-1")) == (3, 5, COMMITTED)
    for k in (2, 3):
        log.stage(spark.range(1), "d", "t", f"p-t-0-{k}")
    assert log.abort_lingering("p", "t", 0, 2) == ["p-t-0-2", "p-t-0-3"] and log.state("p-t-0-2") == UNKNOWN
    with pytest.raises(ValueError, match="committed"):
        log.abort_lingering("p", "t", 0, 1)


def test_stream_applies_each_batch_once(spark, tmp_path):
    table = TableDef("d", "orders", (ColumnDef("id", "INT", False), ColumnDef("v", "STRING"), ColumnDef("seq", "INT")), Model.PRIMARY_KEY, ("id",), "seq")
    log = CommitLog(spark, f"file://{tmp_path}/store")
    split = lambda batch, t: batch.select(F.from_json("value", "id int, v string, seq int, __op int").alias("r")).select("r.*")
    write = sink.batch_writer(log, {"d.orders": table}, split, SinkOptions())
    seen = []

    def run():
        stream = spark.readStream.format("text").load(str(tmp_path / "in"))
        sink.start(stream, lambda df, k: (seen.append(k), write(df, k))[1], str(tmp_path / "cp")).awaitTermination()

    put(tmp_path / "in", "1.json", [{"id": 1, "v": "a", "seq": 1, "__op": 0}, {"id": 2, "v": "b", "seq": 2, "__op": 0}])
    run()
    put(tmp_path / "in", "2.json", [{"id": 1, "v": "c", "seq": 3, "__op": 0}, {"id": 2, "v": "b", "seq": 4, "__op": 1}])
    run()
    run()  # nothing new: no batch runs again
    assert rows(log.read("d", "orders").select("id", "v")) == [(1, "c")] and seen == [0, 1]
    write(spark.createDataFrame([('{"id":9,"v":"z","seq":9,"__op":0}',)], "value string"), 1)  # a replay publishes nothing
    assert rows(log.read("d", "orders").select("id", "v")) == [(1, "c")]


def test_tables_of_a_batch_become_visible_together(spark, tmp_path):
    """Three items for each order in every snapshot, whatever the cut into batches."""
    order = TableDef("d", "orders", (ColumnDef("txn", "INT", False),), Model.DUPLICATE_KEY)
    item = TableDef("d", "items", (ColumnDef("txn", "INT"),), Model.DUPLICATE_KEY)
    log = CommitLog(spark, f"file://{tmp_path}/store")
    split = lambda batch, t: batch.where(F.col("tbl") == t.name).select(F.col("txn").cast("int").alias("txn"))
    write = sink.batch_writer(log, {"d.orders": order, "d.items": item}, split, SinkOptions())
    for k in range(3):
        events = [(k * 10 + t, name) for t in range(4) for name in ("orders", "items", "items", "items")]
        write(spark.createDataFrame(events, "txn int, tbl string"), k)
        assert log.read("d", "items").count() == 3 * log.read("d", "orders").count() == 12 * (k + 1)


def test_assembler_holds_open_transactions(spark, tmp_path):
    def e(p, seq, txn, kind, tbl=None, payload=None):
        return {"source_partition": p, "seq": seq, "txn_id": txn, "type": kind, "db": "d", "tbl": tbl, "payload": payload}

    schema = "source_partition int, seq long, txn_id string, type string, db string, tbl string, payload string"

    def run():
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        out = assemble_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        out.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("source_partition", "txn_id", "payload", "transaction_end"))

    put(tmp_path / "in", "1.json", [e(0, 1, "a", "TXN_BEGIN"), e(0, 2, "a", "DATA", "t", "x"), e(0, 3, "a", "DATA", "u", "y"), e(0, 4, "a", "TXN_END"), e(1, 1, "b", "TXN_BEGIN"), e(1, 2, "b", "DATA", "t", "z")])
    assert run() == [(0, "a", "x", False), (0, "a", "y", True)]
    put(tmp_path / "in", "2.json", [e(1, 3, "b", "TXN_END"), e(0, 5, "c", "DATA", "t", "lost")])
    assert run() == [(0, "a", "x", False), (0, "a", "y", True), (1, "b", "z", True)]


def test_database_sync(spark, tmp_path):
    def env(table, op, before=None, after=None):
        return {"op": op, "before": before, "after": after, "source": {"db": "shop", "table": table}}

    log = CommitLog(spark, f"file://{tmp_path}/store")
    sync = DatabaseSync(spark, log, "ods", prefix="p_", excluding="skip.*")
    cols = (SourceColumn("c0", "int", nullable=False), SourceColumn("c1", "double"), SourceColumn("c2", "varchar", 20))
    sync.discover([SourceTable("shop", "a", cols, ("c0",)), SourceTable("shop", "skipped", cols, ("c0",)), SourceTable("shop", "nokey", cols)])
    assert list(sync.tables) == ["ods.p_a"]
    put(tmp_path / "in", "1.json", [env("a", "c", None, {"c0": 1, "c1": 1.0, "c2": "row1"}), env("a", "c", None, {"c0": 2, "c1": 2.0, "c2": "row2"}), env("skipped", "c", None, {"c0": 9}), env("a", "x")])
    stream = lambda: spark.readStream.format("text").load(str(tmp_path / "in"))
    sync.start(stream(), str(tmp_path / "cp")).awaitTermination()
    put(tmp_path / "in", "2.json", [env("a", "d", {"c0": 1}, None), {"source": {"db": "shop", "table": "a"}, "historyRecord": json.dumps({"ddl": "ALTER TABLE a ADD COLUMN note varchar(20)"})}, env("a", "u", {"c0": 2}, {"c0": 2, "c1": 2.0, "c2": "new", "note": "n"})])
    sync.start(stream(), str(tmp_path / "cp")).awaitTermination()
    assert rows(log.read("ods", "p_a").select("c0", "c1", "c2", "note")) == [(2, 2.0, "new", "n")]


def test_observed_rows(spark):
    df, seen = observed(spark.range(7))
    df.collect()
    assert seen.get["rows"] == 7


def test_labels_stay_committed(spark, tmp_path):
    """However many commits come after, and even if the writer is lost between manifest and marker."""
    log = CommitLog(spark, f"file://{tmp_path}/store")
    for k in range(30):
        assert log.publish(f"p-t-0-{k}", {"d.t": f"file://{tmp_path}/x{k}"})
    log.files.delete(f"{log.root}/labels/p-t-0-29")
    assert log.state("p-t-0-29") == COMMITTED and not log.publish("p-t-0-29", {})
    assert log.publish("p-t-0-30", {}) and log.files.exists(f"{log.root}/labels/p-t-0-29")
    assert all(log.state(f"p-t-0-{k}") == COMMITTED for k in range(31)) and not log.publish("p-t-0-0", {})
    with pytest.raises(ValueError, match="committed"):
        log.rollback("p-t-0-0")


def test_two_writers(spark, tmp_path):
    """Of writers of one name one wins, and commits of several writers at a time are all kept."""
    log = CommitLog(spark, f"file://{tmp_path}/store")
    assert log.files.write_new(f"{log.root}/one", "a") and not log.files.write_new(f"{log.root}/one", "b")
    assert log.files.read(f"{log.root}/one") == "a" and log.files.names(log.root) == ["one"]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: CommitLog(spark, log.root).publish(f"w-t-{k % 4}-{k}", {"d.t": f"file://{tmp_path}/{k}"}), range(24)))
    assert all(done) and log.latest().number == 24 and len(log.latest().tables["d.t"]) == 24


@pytest.mark.parametrize("ops, left", [("cd", []), ("dc", [(1, "1")]), ("uu", [(1, "1")]), ("cdu", [(1, "2")]), ("cud", [])])
def test_changes_of_a_key_in_one_batch(spark, tmp_path, ops, left):
    log = CommitLog(spark, f"file://{tmp_path}/store")
    sync = DatabaseSync(spark, log, "ods")
    sync.discover([SourceTable("shop", "a", (SourceColumn("id", "int", nullable=False), SourceColumn("v", "varchar", 20)), ("id",))])
    lines = []
    for k, op in enumerate(ops):
        row = {"id": 1, "v": str(k)}
        lines.append((json.dumps({"op": op, "before": row, "after": None if op == "d" else row, "source": {"db": "shop", "table": "a", "ts_ms": 5, "pos": k}}),))
    sync.write(spark.createDataFrame(lines[::-1], "value string"), 0)  # the order of arrival does not count
    assert rows(log.read("ods", "a").select("id", "v")) == left


def test_aggregate_table_over_two_batches(spark, tmp_path):
    cols = (ColumnDef("k", "INT", False), ColumnDef("users", "BIGINT", aggregate="BITMAP_UNION"), ColumnDef("about", "BIGINT", aggregate="HLL_UNION"), ColumnDef("mid", "DOUBLE", aggregate="PERCENTILE_UNION"), ColumnDef("s", "DOUBLE", aggregate="SUM"))
    table = TableDef("d", "uv", cols, Model.AGGREGATE, ("k",))
    log = CommitLog(spark, f"file://{tmp_path}/store")
    write = sink.batch_writer(log, {"d.uv": table}, lambda batch, t: batch, SinkOptions())
    schema = "k int, users long, about long, mid double, s double"
    write(spark.createDataFrame([(1, u, u, float(u), 0.1) for u in range(100)] + [(2, None, None, None, None)], schema), 0)
    write(spark.createDataFrame([(1, u, u, float(u), 0.1) for u in range(50, 150)], schema), 1)
    got = {r.k: r for r in sink.read_table(log, table).collect()}
    assert (got[1].users, got[2].users, got[1].s, got[2].s) == (150, 0, 20.0, None)
    assert abs(got[1].about - 150) <= 5 and 70 <= got[1].mid <= 80


def test_gate_and_retries(spark, tmp_path):
    table = TableDef("d", "t", (ColumnDef("id", "INT", False), ColumnDef("v", "STRING")), Model.PRIMARY_KEY, ("id",))
    log = CommitLog(spark, f"file://{tmp_path}/store")
    batch = spark.createDataFrame([(1, "a", 0), (None, "b", 0), (2, "c", 0), (3, None, 1)], "id int, v string, __op int")
    same = lambda b, t: b
    with pytest.raises(ValueError, match="filtered"):
        sink.batch_writer(log, {"d.t": table}, same, SinkOptions())(batch, 0)
    assert log.read("d", "t") is None
    sink.batch_writer(log, {"d.t": table}, same, SinkOptions(max_filter_ratio=0.5))(batch, 0)
    assert rows(log.read("d", "t")) == [(1, "a"), (2, "c")]
    with pytest.raises(ValueError, match="not in"):
        sink.batch_writer(log, {"d.t": table}, same, SinkOptions())(batch.withColumnRenamed("v", "w"), 1)
    with pytest.raises(ValueError, match="one database"):
        other = TableDef("e", "t", table.columns, Model.PRIMARY_KEY, ("id",))
        sink.batch_writer(log, {"d.t": table, "e.t": other}, same, SinkOptions(multi_table=True))(batch, 2)
    waits = []
    with pytest.raises(RuntimeError):
        sink.with_retries(lambda: (_ for _ in ()).throw(RuntimeError("host is away")), 3, sleep=waits.append)
    assert waits == [1.0, 2.0, 3.0]


def test_merge_condition_takes_deletes(spark, tmp_path):
    table = TableDef("d", "t", (ColumnDef("id", "INT", False), ColumnDef("v", "INT")), Model.PRIMARY_KEY, ("id",))
    log = CommitLog(spark, f"file://{tmp_path}/store")
    write = sink.batch_writer(log, {"d.t": table}, lambda b, t: b, SinkOptions(merge_condition="v"))
    write(spark.createDataFrame([(1, 5, 0), (2, 5, 0)], "id int, v int, __op int"), 0)
    write(spark.createDataFrame([(1, 4, 0), (2, 0, 1), (3, 1, 0)], "id int, v int, __op int"), 1)
    assert rows(log.read("d", "t")) == [(1, 5), (3, 1)]


def test_hooks_build_rows(spark, tmp_path):
    table = TableDef("d", "t", (ColumnDef("id", "INT", False), ColumnDef("v", "STRING")), Model.PRIMARY_KEY, ("id",))
    log = CommitLog(spark, f"file://{tmp_path}/store")
    raw = spark.createDataFrame([(1, "a", False), (2, "b", False), (2, "b", True)], "n long, word string, gone boolean")
    build = hooks.build_rows({"ID": F.col("n"), "v": F.upper("word")}, F.col("gone").cast("int"))
    assert rows(build(raw, table)) == [(1, "A", 0), (2, "B", 0), (2, "B", 1)]
    with pytest.raises(ValueError, match="not in t"):
        hooks.build_rows({"x": F.col("n")})(raw, table)
    by_frame = hooks.build_batches(lambda f: f.rename(columns={"n": "id", "word": "v"})[["id", "v"]].assign(__op=f.gone.astype(int)))
    sink.batch_writer(log, {"d.t": table}, by_frame, SinkOptions())(raw.where("n = 1 or gone"), 0)
    assert rows(log.read("d", "t")) == [(1, "a")]


@pytest.mark.parametrize("form, one, two", [("json", '{"id": 1, "v": "a\\tb"}', '{"id": 2, "__op": 1}'), ("csv", '1\t"q', "2\t\\N\t1")])
def test_payloads(spark, form, one, two):
    table = TableDef("d", "t", (ColumnDef("id", "INT", False), ColumnDef("v", "STRING")), Model.PRIMARY_KEY, ("id",))
    records = spark.createDataFrame([("d", "t", one), ("d", "t", two), ("d", "u", one), (None, "t", one), ("d", "t", None)], "db string, tbl string, payload string")
    got = rows(hooks.split_payloads(SinkOptions(format=form))(records, table))
    assert got == [(1, "a\tb" if form == "json" else '"q', 0), (2, None, 1)]
    made = hooks.split_payloads(SinkOptions(format=form), lambda b: b.select(F.lit("d").alias("db"), F.lit("t").alias("tbl"), F.lit(two).alias("payload")))
    assert rows(made(spark.range(1), table)) == [(2, None, 1)]


@pytest.mark.parametrize("form", ["json", "csv"])
def test_payloads_restore_what_lines_encode(spark, form):
    """Booleans, dates and nested values of serialised rows come back; what does not parse is null or fails the load."""
    kinds = {"id": "INT", "ok": "BOOLEAN", "day": "DATE", "tags": "ARRAY<STRING>"}
    table = TableDef("d", "t", tuple(ColumnDef(n, k) for n, k in kinds.items()), Model.DUPLICATE_KEY)
    frame = spark.sql("select 1 id, true ok, date'2024-02-03' day, array('a', 'b') tags union all select 2, false, null, null")
    lines = serialize(frame, form).select(F.lit("d").alias("db"), F.lit("t").alias("tbl"), F.col("value").alias("payload"))
    back = hooks.split_payloads(SinkOptions(format=form))(lines, table).drop("__op")
    assert back.schema.simpleString() == frame.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    bad = spark.createDataFrame([("d", "t", '{"id": "x"}' if form == "json" else "x")], "db string, tbl string, payload string")
    assert hooks.split_payloads(SinkOptions(format=form))(bad, table).collect()[0].id is None
    with pytest.raises(Exception, match="MALFORMED|CAST_INVALID"):
        hooks.split_payloads(SinkOptions(format=form, strict_mode=True))(bad, table).collect()


def test_one_load_compressed_and_labelled(spark, tmp_path):
    table = TableDef("d", "t", (ColumnDef("id", "INT", False),), Model.DUPLICATE_KEY)
    log = CommitLog(spark, f"file://{tmp_path}/store")
    frame = spark.createDataFrame([(1,), (2,)], "id int")
    one = sink.load(log, table, frame, SinkOptions(label_prefix="p", compression="lz4_frame"))
    assert one.startswith("p-") and sink.load(log, table, frame, SinkOptions(), one) == one
    assert log.read("d", "t").count() == 2 and list((tmp_path / "store/data/d/t" / one).glob("*.lz4raw.parquet"))
    sink.load(log, table, frame, SinkOptions())
    assert log.read("d", "t").count() == 4
    waits = []
    log.stage(frame, "d", "t", "open")
    assert log.wait_for(one, sleep=waits.append) == COMMITTED and log.wait_for("none", sleep=waits.append) == UNKNOWN and not waits
    assert log.wait_for("open", 12, sleep=waits.append) == PREPARED and waits == [0, 1, 2, 3, 4, 2]


def test_limits_of_loads(spark):
    options = SinkOptions(multi_table=True, multi_table_buffer=10)
    batch = spark.createDataFrame([(0, "a", "x" * 12), (0, "a", "x" * 8), (1, "a", "x" * 9), (0, None, "x" * 99)], "source_partition int, txn_id string, payload string")
    assert sink.check_transactions(batch, options).count() == 4
    with pytest.raises(ValueError, match="21 bytes"):
        sink.check_transactions(batch.union(spark.createDataFrame([(0, "a", "x")], batch.schema)), options)
    assert sink.reader_limits(SinkOptions()) == {"maxBytesPerTrigger": str(90 << 20)}
    assert sink.reader_limits(SinkOptions(), "kafka") == {"maxOffsetsPerTrigger": "500000", "maxTriggerDelay": "300000ms"}
    made = sink_options(["sink.max-retries=5", "buffer-flush.max-bytes=128m"])
    assert (made.semantic, made.format, made.max_retries, made.flush_max_bytes) == ("exactly-once", "json", 5, 128 << 20)


@pytest.mark.parametrize("how", ["upsert", "partial", "condition"])
def test_keyed_loads_write_what_they_touch(spark, tmp_path, monkeypatch, how):
    """Loads are deltas that reads merge; deltas of like size become one, and old folders go."""
    monkeypatch.setattr(commit, "FAN", 3)
    table = TableDef("d", "t", (ColumnDef("id", "INT", False), ColumnDef("v", "INT"), ColumnDef("w", "INT")), Model.PRIMARY_KEY, ("id",))
    log = CommitLog(spark, f"file://{tmp_path}/store")
    options = SinkOptions(partial_update=how == "partial", merge_condition="v" if how == "condition" else None)
    write = sink.batch_writer(log, {"d.t": table}, lambda b, t: b, options)
    want = {}
    for k in range(11):
        batch = [(i, 50, k, 0) for i in range(40)] if k == 0 else [(k, (53 * k) % 100, k, 0), (30 + k, 99, k, 1), (20, 0, 0, k % 2), (100 + k, k, k, 0)]
        frame = spark.createDataFrame(batch, "id int, v int, w int, __op int")
        write(frame.drop("w") if how == "partial" else frame, k)
        for i, v, w, op in batch:
            if op:
                want.pop(i, None)
            elif how == "partial":
                want[i] = (v, want.get(i, (0, None))[1])
            elif how == "upsert" or i not in want or v >= want[i][0]:
                want[i] = (v, w)
        if k in (1, 4, 10):
            assert {r.id: (r.v, r.w) for r in log.read("d", "t").collect()} == want
        if k == 1:
            assert spark.read.parquet(log.folders("d", "t")[-1]).count() == 4
    assert log.latest().loads["d.t"] == [9, 1, 1]
    assert log.vacuum(keep=1) == 8 and {r.id: (r.v, r.w) for r in log.read("d", "t").collect()} == want
    assert log.state(label("load", "all", 0, 0)) == COMMITTED and log.vacuum(1) == 0


def test_stale_merges_conflict(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/store")
    for k in range(3):
        log.publish(f"l{k}", {"d.t": f"x{k}"})
    for part in (commit.Part("y", covers=("x0", "x1")), commit.Part("y", seen=("x0",)), commit.Part("y", covers=("x9", "x0", "x1", "x2"))):
        with pytest.raises(commit.Conflict):
            log.publish("m", {"d.t": part})
    assert log.publish("m", {"d.t": commit.Part("y", covers=("x1", "x2"))})
    assert log.folders("d", "t") == ("x0", "y") and log.latest().loads["d.t"] == [1, 3]
