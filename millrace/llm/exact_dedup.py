"""Exact dedup by content sort: range-partition normalised bytes by sampled splitters, sort, compare neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._base import Scratch, ascii_lower, partitions

#: Characters of the text in the range key. The rest of the order is a content hash and then the whole text, so
#: sampled splitters stay small however long the texts are, and documents that open alike still spread out.
KEY_CHARS = 32


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only. Of equal texts one row stays, that of the ``smallest``
    or ``largest`` identifier. Rows are range-partitioned by sampled splitters over (opening bytes, content hash),
    sorted externally by (opening bytes, hash, whole text, identifier), and each run of equal neighbours is one group:
    the window compares each whole text with the one before it. A text with more than a quarter of a partition's fair
    share of rows takes another way: its rows are aggregated before any shuffle and its one summary row joined back,
    so no task holds a large group.

    Null text counts as empty. A null identifier loses against any other; if all are null, ``keep_id`` is null and one
    row stays. Repeated rows (same identifier, same text) are one group of which one row stays. An empty table gives
    an empty result. Other columns are ignored, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    parts = partitions(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Equal under A-Z lowering implies equal under full lowering, so the cheap full lowering can order and hash.
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.lower(text).alias("low"),
        text.alias("raw"),
    ).select(
        "doc_id",
        F.substring("low", 1, KEY_CHARS).alias("head"),
        F.xxhash64("low").alias("h"),
        ascii_lower(F.col("raw")).alias("norm"),
    )
    counts = base.groupBy("h").count()
    total = docs.count()
    hot_from = max(64, total // (4 * parts))
    # at most 4 * parts + 1 rows by construction, so the broadcast below is bounded
    hot = Scratch(spark, "exact").save(counts.where(F.col("count") > hot_from).select("h"), "hot")
    best = F.min if keep == "smallest" else F.max
    order = F.asc_nulls_last("doc_id") if keep == "smallest" else F.desc_nulls_last("doc_id")
    group = Window.partitionBy("head", "h", "norm")
    sha = F.sha2(F.col("norm"), 256).alias("text_sha256")

    def ordinary(rows: DataFrame) -> DataFrame:
        ranged = rows.repartitionByRange(parts, "head", "h").sortWithinPartitions("head", "h", "norm", order)
        return ranged.select(
            "doc_id",
            best("doc_id").over(group).alias("keep_id"),
            F.count(F.lit(1)).over(group).alias("group_size"),
            (F.row_number().over(group.orderBy(order)) == 1).alias("kept"),
            sha,
        )

    if hot.isEmpty():
        return ordinary(base)
    cold_rows = base.join(F.broadcast(hot), "h", "left_anti")
    hot_rows = base.join(F.broadcast(hot), "h", "left_semi")
    # partial aggregation: each task passes on one row for each hot text
    summary = hot_rows.groupBy("h", "norm").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    summary = summary.withColumn("text_sha256", sha)
    r, s = hot_rows.alias("r"), F.broadcast(summary).alias("s")
    joined = r.join(s, (F.col("r.h") == F.col("s.h")) & (F.col("r.norm") == F.col("s.norm"))).select(
        "r.doc_id", "s.keep_id", "s.group_size", "s.text_sha256"
    )
    is_best = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    losers = joined.where(~is_best).withColumn("kept", F.lit(False))
    # the rows that carry the best identifier: one, unless rows repeat; the window then lets one of them stay
    one = Window.partitionBy("text_sha256").orderBy("doc_id")
    winners = joined.where(is_best).withColumn("kept", F.row_number().over(one) == 1)
    both = losers.unionByName(winners).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return ordinary(cold_rows).unionByName(both)
