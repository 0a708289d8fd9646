"""A Python data source over a keyed table's files: ``spark.read.format("millrace")``.

It exists for hosts that want the protocol (splits, pushed filters, Arrow batches). Python data sources get no column
pruning, so plain Parquet reads stay the way to scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringStartsWith,
)
from pyspark.sql.types import StructType


@dataclass
class Groups(InputPartition):
    """Row groups of one file."""

    path: str
    first: int
    last: int


def _condition(f: Filter):
    import pyarrow.compute as pc

    if isinstance(f, Not):
        inner = _condition(f.child)
        return None if inner is None else ~inner
    if len(getattr(f, "attribute", ())) != 1:
        return None
    c = pc.field(f.attribute[0])
    simple = {
        EqualTo: lambda: c == f.value, GreaterThan: lambda: c > f.value, GreaterThanOrEqual: lambda: c >= f.value,
        LessThan: lambda: c < f.value, LessThanOrEqual: lambda: c <= f.value, In: lambda: c.isin(list(f.value)),
        IsNull: lambda: c.is_null(), IsNotNull: lambda: c.is_valid(), StringStartsWith: lambda: pc.starts_with(c, f.value),
    }
    return simple[type(f)]() if type(f) in simple else None


class TableSource(DataSource):
    """Options: ``path`` (a Parquet file or folder that pyarrow can open), ``columns``, ``batchRows``."""

    @classmethod
    def name(cls) -> str:
        return "millrace"

    def schema(self) -> StructType:
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import from_arrow_schema

        whole = from_arrow_schema(ds.dataset(self.options["path"]).schema, prefer_timestamp_ntz=True)
        wanted = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        return StructType([whole[c] for c in wanted]) if wanted else whole

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(self.options["path"], schema, int(self.options.get("batchrows", 65_536)))


class TableReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, batch_rows: int):
        self.path, self.columns, self.batch_rows = path, schema.names, batch_rows
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if _condition(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[InputPartition]:
        import pyarrow.dataset as ds

        return [
            Groups(frag.path, k, k + 1)
            for frag in ds.dataset(self.path).get_fragments()
            for k in range(frag.metadata.num_row_groups)
        ]

    def read(self, partition: Groups) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        condition = None
        for f in self.filters:
            one = _condition(f)
            condition = one if condition is None else condition & one
        frag = next(iter(ds.dataset(partition.path).get_fragments()))
        part = frag.subset(row_group_ids=list(range(partition.first, partition.last)))
        for batch in part.to_batches(columns=self.columns, filter=condition, batch_size=self.batch_rows):
            if batch.num_rows:
                yield batch


def register(spark) -> None:
    """Make the format known to a session, with the filter pushdown that it implements switched on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TableSource)
