"""Table scans with column, predicate, count and limit pushdown, and split planning."""

from __future__ import annotations

import random
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import predicates
from millrace.sources.options import ScanOptions


def select_columns(schema: T.StructType, text: str) -> list[str]:
    """Column names of a comma list, in its order; an empty list means all. Unknown names are an error."""
    names = [c.strip().strip("`") for c in text.split(",") if c.strip()]
    known = {f.name for f in schema.fields}
    for n in names:
        if n not in known:
            raise ValueError(f"column not found in the table schema: {n}")
    return names or [f.name for f in schema.fields]


def scan(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    where: Sequence[Any] | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """A declarative scan. Filters come first and projections last, so the optimizer pushes both into the file scan:
    ``where`` is SQL text or a list of predicates, all of which must hold. An empty column list is a count-only scan."""
    out = table
    if isinstance(where, str) and where.strip():
        out = out.where(where)
    elif where and not isinstance(where, str):
        for e in where:
            whole = predicates.to_column(e)
            out = out.where(whole)
    if columns is not None:
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    return out if limit is None else out.limit(limit)


def scan_text(table: DataFrame, options: ScanOptions) -> DataFrame:
    """A scan by option texts. A column text that holds ``count(`` makes it a count."""
    out = table.where(options.filter) if options.filter.strip() else table
    if re.search(r"count\s*\(", options.columns, re.I):
        return out.select(F.count(F.lit(1)).alias("count"))
    out = out.select(*[F.col(f"`{c}`") for c in select_columns(table.schema, options.columns)])
    return out.limit(options.limit) if options.limit is not None else out


def count_only(table: DataFrame, where: str | None = None) -> DataFrame:
    """How many rows there are: reads no column but those of the filter."""
    return scan(table, None, where).agg(F.count(F.lit(1)).alias("n"))


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def remote_query(database: str, table: str, columns: Sequence[str], conjuncts: Sequence[Any]) -> tuple[str, list[Any]]:
    """The SELECT text of a scan and the predicates that it does not cover."""
    text, _, rest = predicates.push_down(conjuncts)
    listed = ",".join(f"`{c}`" for c in columns) or "*"
    return f"select {listed} from `{database}`.`{table}`" + (f" where {text}" if text else ""), rest


def not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fails on a null in a column that is declared NOT NULL; file readers do not check that themselves."""
    declared = columns if columns is not None else [f.name for f in df.schema.fields if not f.nullable]
    out = df
    for c in declared:
        bad = F.raise_error(F.lit(f"The value is null for a non-nullable column: {c}"))
        out = out.withColumn(c, F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`")).otherwise(bad.cast(df.schema[c].dataType)))
    return out


def choose_hosts(replicas: Mapping[int, Sequence[str]]) -> dict[str, list[int]]:
    """For each split a host that holds it: the first one not in use yet, or else the one with the fewest splits."""
    out: dict[str, list[int]] = {}
    for split, hosts in replicas.items():
        fresh = next((h for h in hosts if h not in out), None)
        host = fresh if fresh is not None else min(hosts, key=lambda h: len(out[h]))
        out.setdefault(host, []).append(split)
    return out


def assign_splits(tasks: int, by_host: Mapping[str, Sequence[int]]) -> list[list[tuple[str, list[int]]]]:
    """Splits for each task. As many tasks as hosts: a host each; fewer: hosts in turn; more: single splits in runs of
    equal length, rounded, with what is left over to the last task."""
    hosts = [(h, list(s)) for h, s in by_host.items()]
    out: list[list[tuple[str, list[int]]]] = [[] for _ in range(tasks)]
    if tasks <= len(hosts):
        for k, group in enumerate(hosts):
            out[k % tasks].append(group)
        return out
    single = [(h, s) for h, own in hosts for s in own]
    run = max(1, int(len(single) / tasks + 0.5))
    for k in range(tasks):
        stop = len(single) if k == tasks - 1 else (k + 1) * run
        groups: dict[str, list[int]] = {}
        for h, s in single[k * run : stop]:
            groups.setdefault(h, []).append(s)
        out[k] = list(groups.items())
    return out


def pick_host(urls: str, seed: int | None = None) -> str:
    """One of a comma list of hosts, at random."""
    return random.Random(seed).choice([u.strip() for u in urls.split(",") if u.strip()])
