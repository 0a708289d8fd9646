"""Streaming loads: micro-batches applied to keyed tables, one atomic commit for all tables of a batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import FINAL_FAILURES
from millrace.operators import changelog, keyed, transactions
from millrace.plans.tables import Model, TableDef, check_sink
from millrace.sources.options import SinkOptions
from millrace.streaming.commit import CommitLog, Part, label, random_label

T = TypeVar("T")


def apply_batch(log: CommitLog, table: TableDef, rows: DataFrame, options: SinkOptions) -> tuple[DataFrame, Part]:
    """What to stage for one table, and the folders of it whose place that takes.

    Rows of keyed tables may carry ``__op``. Keyed and aggregate tables get what the load changes, merged on read; when
    it is their turn, older changes of like size are merged into it. Append tables get the rows as they are.
    """
    if table.model is Model.AGGREGATE:
        functions = load_functions(table)
        state = keyed.aggregate_state(rows, table.keys, functions, sequence=[table.sequence] if table.sequence else [])
        covers = log.due(table.database, table.name)
        if covers:
            state = keyed.merge_states(log.spark.read.parquet(*covers).unionByName(state), table.keys, functions)
        return state, Part(covers=covers)
    if table.model is not Model.PRIMARY_KEY:
        return keyed.append(log.spark.createDataFrame([], table.schema), rows.drop("__op", changelog.SEQUENCE)), Part()
    folders, covers = log.folders(table.database, table.name), log.due(table.database, table.name)
    delta = changed_rows(log, table, rows, options)
    part = Part(covers=covers, keys=table.keys, seen=folders if options.partial_update or options.merge_condition or not folders else None)
    if len(covers) == len(folders):  # the first load, or all of the table: a snapshot
        old = log.read(table.database, table.name)
        return keyed.apply_changes(delta, table.keys, [], old).select([c.name for c in table.columns]), part
    if covers:
        both = log.changes(covers).unionByName(delta.withColumn("_at", F.lit(len(covers))), allowMissingColumns=True)
        delta = keyed.latest(both, table.keys, ["_at"]).drop("_at")
    return delta, part


def changed_rows(log: CommitLog, table: TableDef, rows: DataFrame, options: SinkOptions) -> DataFrame:
    """A row with ``__op`` for each key that a load of a keyed table touches: what the table has of it afterwards, or a
    delete. Old rows are read for partial and conditional updates only, and of the touched keys alone."""
    order = [table.sequence] if table.sequence else [c for c in rows.columns if c == changelog.SEQUENCE]
    columns = [c.name for c in table.columns]
    deletes = "__op" in rows.columns
    if not (options.partial_update or options.merge_condition):
        marked = rows if deletes else rows.withColumn("__op", F.lit(changelog.UPSERT))
        return keyed.latest(marked, table.keys, order).select(*columns, "__op")
    touched = rows.select(*table.keys).distinct()
    base = log.read(table.database, table.name)
    old = log.spark.createDataFrame([], table.schema) if base is None else base.join(touched, list(table.keys), "left_semi")
    if options.partial_update:
        new = keyed.partial_update(old, rows, table.keys, sequence=order)
    else:
        # deletes take effect whatever the condition says; the rest must meet it
        live = rows
        if deletes:
            last = keyed.latest(rows, table.keys, order)
            old = keyed.apply_changes(last.where(F.col("__op") == changelog.DELETE), table.keys, order, old)
            live = last.where(F.col("__op") == changelog.UPSERT).drop("__op")
        new = keyed.conditional_update(old, live, table.keys, options.merge_condition, sequence=order)
    op = F.when(F.col("_there"), changelog.UPSERT).otherwise(changelog.DELETE)
    return touched.join(new.withColumn("_there", F.lit(True)), list(table.keys), "left").select(*columns, op.alias("__op"))


def load_functions(table: TableDef) -> dict[str, str]:
    return {c.name: c.aggregate for c in table.columns if c.name not in table.keys}


def read_table(log: CommitLog, table: TableDef) -> DataFrame | None:
    """The table as readers see it: aggregate tables hold mergeable state, which is finished here."""
    rows = log.read(table.database, table.name)
    if rows is None or table.model is not Model.AGGREGATE:
        return rows
    functions = load_functions(table)
    if len(log.folders(table.database, table.name)) > 1:
        rows = keyed.merge_states(rows, table.keys, functions)
    return keyed.finish_states(rows, functions)


def final(error: Exception) -> bool:
    """Whether a failed load must not be tried again: it would fail for the same lasting cause."""
    said = str(error).lower()
    return isinstance(error, (ValueError, TypeError)) or any(words in said for words in FINAL_FAILURES)


def with_retries(load: Callable[[], T], tries: int, pause_s: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of ``load``, tried again up to ``tries`` more times with growing pauses unless the failure is final."""
    for k in range(tries + 1):
        try:
            return load()
        except Exception as e:
            if k == tries or final(e):
                raise
            sleep(min(pause_s * (k + 1), 10.0))
    raise AssertionError


def checked(rows: DataFrame, table: TableDef, options: SinkOptions) -> DataFrame:
    """Rows that the table takes. Columns and types are checked against it; rows with a null in a NOT NULL column are
    filtered, and more of them than ``max_filter_ratio`` allows fail the load."""
    own = rows.drop("__op", changelog.SEQUENCE)
    if table.model is not Model.AGGREGATE:
        check_sink(table, own.schema)
    needed = [c.name for c in table.columns if not c.nullable and c.name in own.columns]
    if not needed:
        return rows
    good = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in needed])
    if "__op" in rows.columns:  # a delete needs its keys only
        good = good | ((F.col("__op") == changelog.DELETE) & reduce(and_, [F.col(f"`{c}`").isNotNull() for c in table.keys or needed]))
    return keyed.quality_gate(rows, good, options.max_filter_ratio)


def load(log: CommitLog, table: TableDef, rows: DataFrame, options: SinkOptions, one: str | None = None) -> str:
    """Load ``rows`` into one table and return the label, by default a new one. A label that is committed already counts
    as loaded."""
    one = one or random_label(options.label_prefix)
    if not log.committed(one):
        out, part = apply_batch(log, table, checked(rows, table, options), options)
        where = with_retries(lambda: log.stage(out, table.database, table.name, one, options.compression), options.max_retries)
        staged = {f"{table.database}.{table.name}": replace(part, where=where)}
        with_retries(lambda: log.publish(one, staged), options.max_retries)
    return one


def check_transactions(batch: DataFrame, options: SinkOptions) -> DataFrame:
    """Rows of a load over several tables, where they carry what the checks need: partitions are named, and no
    transaction is larger than twice the buffer."""
    if "source_partition" in batch.columns:
        batch = transactions.check_partitions(batch)
    if {"txn_id", "payload"} <= set(batch.columns):
        by = [c for c in ("source_partition", "txn_id") if c in batch.columns]
        sized = batch.where("txn_id is not null").select(*by, F.octet_length("payload").alias("_size"))
        if big := transactions.check_sizes(sized, by, "_size", options.multi_table_buffer).head():
            raise ValueError(f"transaction {big['txn_id']} has {big['bytes']} bytes, over twice the buffer of {options.multi_table_buffer}")
    return batch


def batch_writer(
    log: CommitLog,
    tables: Mapping[str, TableDef],
    split: Callable[[DataFrame, TableDef], DataFrame],
    options: SinkOptions,
    prefix: str = "load",
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: rows of each table, from ``split``, are staged under the label of the batch and
    published together. Running a batch again publishes nothing twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        one = label(options.label_prefix or prefix, "all", 0, batch_id)
        if options.blackhole:
            batch.write.format("noop").mode("overwrite").save()
            return
        if log.committed(one):
            return
        if options.multi_table:
            transactions.check_one_database([t.database for t in tables.values()])
            batch = check_transactions(batch, options)
        batch = batch.persist()
        try:
            staged = {}
            for key, table in tables.items():
                rows = split(batch, table)
                if rows.isEmpty():
                    continue
                out, part = apply_batch(log, table, checked(rows, table, options), options)
                stage = lambda out=out, table=table: log.stage(out, table.database, table.name, one, options.compression)
                staged[key] = replace(part, where=with_retries(stage, options.max_retries))
            if staged:
                with_retries(lambda: log.publish(one, staged), options.max_retries)
        finally:
            batch.unpersist()

    return write


def reader_limits(options: SinkOptions, source: str = "files") -> dict[str, str]:
    """Reader options that keep a micro-batch within the limits at which buffers are flushed: bytes of files, or rows of
    a broker's topic, which also waits for no longer than the interval."""
    if source == "kafka":
        return {"maxOffsetsPerTrigger": str(options.flush_max_rows), "maxTriggerDelay": f"{options.flush_interval_ms}ms"}
    return {"maxBytesPerTrigger": str(options.multi_table_buffer if options.multi_table else options.flush_max_bytes)}


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, interval_ms: int | None = None):
    """A running query: at each interval, or over all that is there and then done."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{interval_ms} milliseconds") if interval_ms else writer.trigger(availableNow=True)).start()


def split_by_route(keys: Sequence[str] = ("db", "tbl")) -> Callable[[DataFrame, TableDef], DataFrame]:
    """Rows of routed envelopes for a table: decoded, typed, without changes that loads ignore."""

    def split(batch: DataFrame, table: TableDef) -> DataFrame:
        db, tbl = keys
        # a broker's offset orders arrivals; in files the order of lines does
        arrival = F.col("offset") if "offset" in batch.columns else F.monotonically_increasing_id()
        batch = batch.withColumn("_arrived", arrival)
        own = batch.where((F.col(tbl) == table.name) & F.coalesce(F.col(db) == table.database, F.lit(True)))
        fields = table.schema
        return changelog.typed(changelog.decode_envelopes(own, fields, arrival=F.col("_arrived")), fields)

    return split
