"""Helpers that the operators of this subpackage share: scratch tables, size-checked joins, column hygiene."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when a count has shown that it has at most this many (key-only) rows: 16 bytes
#: each, so 8 MB. Beyond it the join is a shuffle join, where adaptive execution splits skewed partitions.
BROADCAST_ROWS = 500_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. A session without spark.checkpoint.dir (tests) gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Intermediate tables in the shared folder. They cut lineage, so a lost executor costs one stage and not the job.

    ``save`` writes a table and reads it back; ``drop`` deletes it once nothing will read it again. Tables behind a
    returned DataFrame stay; whoever owns the checkpoint folder clears it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._paths: dict[int, str] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


    def clean(self) -> None:
        """Has Spark delete the shuffle files of queries that are over: its cleaner learns of them when the driver
        collects garbage, which may otherwise be long after."""
        self.spark.sparkContext._jvm.System.gc()


def replacing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns that a result column is about to take the name of (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows it small; otherwise as it is. Call it on scratch tables."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case and nothing else. Pure ASCII strings, the bulk, take the vectorised ``lower``."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
