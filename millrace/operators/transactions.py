"""Transactions in a change stream: whole ones are kept, open ones wait; checks for loads over several tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEGIN, DATA, END = "TXN_BEGIN", "DATA", "TXN_END"


def assemble(events: DataFrame, partition: str, order: Sequence[str], kind: str = "type") -> DataFrame:
    """DATA rows of closed transactions with ``txn_no`` in the partition and ``transaction_end`` on the last row of each.

    A BEGIN discards what was open before it; rows outside of any transaction and without an END are held back.
    """
    w = Window.partitionBy(partition).orderBy(*order)
    begun = events.withColumn("txn_no", F.count_if(F.col(kind) == BEGIN).over(w))
    g = Window.partitionBy(partition, "txn_no")
    first_end = F.min(F.when(F.col(kind) == END, F.struct(*order))).over(g)
    closed = begun.withColumn("_end", first_end).where(
        (F.col("txn_no") > 0) & F.col("_end").isNotNull() & (F.struct(*order) < F.col("_end")) & (F.col(kind) == DATA)
    )
    is_last = F.struct(*order) == F.max(F.struct(*order)).over(g)
    return closed.withColumn("transaction_end", is_last).drop("_end", kind)


def check_partitions(rows: DataFrame, partition: str = "source_partition") -> DataFrame:
    """Fails on rows without a partition number of 0 or more, which loads over several tables need."""
    bad = F.raise_error(F.lit("a load over several tables needs a source partition of 0 or more")).cast("int")
    c = F.col(partition)
    return rows.withColumn(partition, F.when(c >= 0, c).otherwise(bad.cast(rows.schema[partition].dataType)))


def check_one_database(databases: Sequence[str]) -> str:
    """One transaction covers tables of one database."""
    found = sorted(set(databases))
    if len(found) != 1:
        raise ValueError(f"a transaction covers one database, not {found}")
    return found[0]


def check_sizes(rows: DataFrame, transaction: Sequence[str], size: str, buffer_bytes: int) -> DataFrame:
    """Transactions of more than twice the buffer, which cannot be loaded in one piece."""
    return rows.groupBy(*transaction).agg(F.sum(size).alias("bytes")).where(F.col("bytes") > 2 * buffer_bytes)


def partitions_without_end(events: DataFrame, partition: str, kind: str = "type") -> DataFrame:
    """Partitions that wrote rows but never closed a transaction: a savepoint must not pass them."""
    seen = events.groupBy(partition).agg(F.count_if(F.col(kind) == DATA).alias("n"), F.count_if(F.col(kind) == END).alias("ends"))
    return seen.where("n > 0 and ends = 0").select(partition)


def dispatch(rows: DataFrame, db: str = "db", tbl: str = "tbl", payload: str = "payload") -> DataFrame:
    """Rows that name a database, a table and a payload; others are dropped."""
    named = F.col(db).isNotNull() & F.col(tbl).isNotNull() & F.col(payload).isNotNull()
    return rows.where(named)


def flush_interval_ms(commit_interval_ms: int) -> int:
    """How often rows move inside a commit interval: a tenth of it, from 100 ms to 1 s."""
    return min(1_000, max(100, commit_interval_ms // 10))
