"""Load chunks: framing, byte accounting, cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frame_overhead(fmt: str, row_delimiter: str = "\n") -> tuple[int, int, int]:
    """Bytes before the first row, between rows, and after the last: JSON is an array, CSV ends with a delimiter."""
    d = len(row_delimiter.encode())
    return (1, 1, 1) if fmt == "json" else (0, d, d)


def chunk_bytes(n_rows: int, payload: int, fmt: str, row_delimiter: str = "\n") -> int:
    first, between, last = frame_overhead(fmt, row_delimiter)
    return first + last + payload + max(0, n_rows - 1) * between


def running_bytes(rows: DataFrame, block: Sequence[str], order: Sequence[str], size: Column) -> DataFrame:
    """``rows`` with ``bytes_before`` and ``bytes_through``: sums of ``size`` over all rows in (block, order).

    A prefix sum in two steps: inside each block, and over one total a block. Blocks are columns that cut the order into
    runs of bounded size, so no task sees all rows.
    """
    sized = rows.withColumn("_size", size.cast("long"))
    totals = sized.groupBy(*block).agg(F.sum("_size").alias("_total"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*block, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*block).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sized.withColumn("_run", F.sum("_size").over(inside)).join(offsets, list(block))
    through = F.col("_offset") + F.col("_run")
    return run.withColumn("bytes_through", through).withColumn("bytes_before", through - F.col("_size")).drop("_size", "_run", "_offset")


def cut_chunks(rows: DataFrame, group: Sequence[str], order: Sequence[str], line: str, *, max_bytes: int, max_rows: int, fmt: str = "csv", row_delimiter: str = "\n") -> DataFrame:
    """``rows`` with ``chunk`` (from 0) and ``place`` in it, within each group in order: a chunk closes before the row
    that would pass ``max_bytes`` (with framing) or ``max_rows``.

    The cut depends on all rows before it, so it is a sequential fold over a group; only sizes take part in it.
    """
    import pandas as pd

    first, between, last = frame_overhead(fmt, row_delimiter)
    keys = [*group, *order]
    narrow = rows.select(*keys, F.octet_length(line).alias("_size"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        chunks, places, chunk, n, total = [], [], 0, 0, first + last
        for size in pdf["_size"].fillna(0).astype(int):
            step = size + (between if n else 0)
            if n and (total + step > max_bytes or n >= max_rows):
                chunk, n, total, step = chunk + 1, 0, first + last, size
            chunks.append(chunk)
            places.append(n)
            n += 1
            total += step
        return pdf.assign(chunk=chunks, place=places).drop(columns="_size")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields if f.name != "_size")
    cut = narrow.groupBy(*group).applyInPandas(fold, fields + ", chunk long, place long")
    return rows.join(cut, keys)


def frame(rows: DataFrame, chunk: Sequence[str], order: Sequence[str], line: str, fmt: str = "csv", row_delimiter: str = "\n") -> DataFrame:
    """One ``body`` for each chunk: CSV rows each followed by the delimiter, JSON rows as an array."""
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct(*order, F.col(line).alias("_line")))), lambda x: x["_line"]
    )
    joined = F.array_join(ordered, row_delimiter if fmt == "csv" else ",")
    body = F.concat(joined, F.lit(row_delimiter)) if fmt == "csv" else F.concat(F.lit("["), joined, F.lit("]"))
    return rows.groupBy(*chunk).agg(body.alias("body"), F.count(F.lit(1)).alias("n_rows"))
