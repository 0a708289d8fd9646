"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._base import Scratch, replacing
from millrace.llm._base import partitions as shuffle_partitions

#: Bounds of the driver-side tables: virtual partitions, and second-stage ranges within a shard.
MAX_PARTITIONS = 4_096
MAX_RANGES = 4_096
ROWS_A_TASK = 250_000
_SPAN = 1 << 62
#: Parts that equal rows of one identifier are dealt over, and bits of the content hash that cut an identifier's rows.
DEALS = 256
BLOCK_BITS = 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """An exact draw of how many of ``n`` items, taken from ``good + bad``, are good; totals may pass 10**9."""
    if good == 0 or n == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    # inversion outward from the mode: steps in proportion to the standard deviation
    lo, hi = max(0, n - bad), min(n, good)
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (good + bad + 2)))

    def choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    p = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    u = rng.random() - p
    up, down, k_up, k_down = p, p, mode, mode
    while u > 0:
        moved = False
        if k_up < hi:
            up *= (good - k_up) * (n - k_up) / ((k_up + 1) * (bad - n + k_up + 1))
            k_up += 1
            u -= up
            moved = True
            if u <= 0:
                return k_up
        if k_down > lo:
            down *= k_down * (bad - n + k_down) / ((good - k_down + 1) * (n - k_down + 1))
            k_down -= 1
            u -= down
            moved = True
            if u <= 0:
                return k_down
        if not moved:
            break
    return mode


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts by (partition, shard) with the given margins, distributed as under a uniform permutation of all rows."""
    if sum(rows) != sum(shards):
        raise ValueError("margins differ")
    rng = np.random.default_rng(seed)
    left = list(shards)
    out = np.zeros((len(rows), len(shards)), np.int64)
    for p, n in enumerate(rows):
        rest = sum(left)
        for s, room in enumerate(left):
            rest -= room
            k = hypergeometric(rng, room, rest, n)
            out[p, s] = k
            n -= k
            left[s] -= k
    return out


def _ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``_n``, the place (from 0) of a row among those of its identifier (``_vp, _go``) by content hash
    ``_h``, and without ``_h``. Equal rows are dealt over ``DEALS`` parts, which are kept in a table so that a task that
    runs again finds the same ones; places are sums of counts of blocks, contents and parts, so each window sees a few.
    """
    rows = rows.withColumn("_deal", F.pmod(F.monotonically_increasing_id(), F.lit(DEALS)).cast("int"))
    rows = scratch.save(rows.withColumn("_block", F.shiftrightunsigned("_h", 64 - BLOCK_BITS)), "tied")
    part = ["_vp", "_go", "_block", "_h", "_deal"]
    counts = scratch.save(rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_c")), "counts")

    def before(*within: str, order: list[str]) -> Column:
        w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(w), F.lit(0))

    blocks = counts.groupBy("_vp", "_go", "_block").agg(F.sum("_c").alias("_c"))
    blocks = blocks.select("_vp", "_go", "_block", before("_vp", "_go", order=["_block"]).alias("_from"))
    inner = counts.withColumn("_before", before("_vp", "_go", "_block", order=["_h", "_deal"])).join(blocks, ["_vp", "_go", "_block"])
    places = inner.select(*part, (F.col("_from") + F.col("_before")).alias("_before"))
    own = Window.partitionBy(*part).orderBy("_h")
    out = rows.withColumn("_n", F.row_number().over(own) - 1).join(places, part)
    return out.withColumn("_n", F.col("_n") + F.col("_before")).drop("_h", "_deal", "_block", "_before")


def shard(
    rows: DataFrame, n_shards: int, *, id_col: str = "doc_id", seed: int = 7, partitions: int | None = None
) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1, sizes at most one apart) and ``slot`` (gapless from 0 in a shard).

    1. Rows fall into virtual partitions by a hash of the identifier; their sizes come from a count of that one column.
    2. Exact partition-to-shard counts are drawn (``communication_matrix``): at most 4,096 x n_shards numbers.
    3. Locally, a partition's rows are permuted by a second hash. The matrix row cuts this order into shards; the cut
       places, found on narrow rows, go to all tasks as one bounded table, so whole rows are not shuffled for it.
    4. One exchange moves each whole row to a range of its shard's second permutation, where it gets its slot.

    Placement depends on the rows, their count, the number of partitions and the seed, so a recomputed task places rows as before.
    Rows that share an identifier tie in the first order; where a cut falls between them they are dealt in the order of
    their content hash (``_ranked``), so sizes stay exact and no task gets all rows of an identifier. The second order
    looks at the content too. Null identifiers are one such tie. An empty table gives an empty result.
    Input columns named shard or slot are replaced; all others pass through.
    """
    if n_shards < 1:
        raise ValueError("n_shards is at least 1")
    spark = rows.sparkSession
    scratch = Scratch(spark, "shard")
    rows = replacing(rows, ["shard", "slot", "_vp", "_cut", "_go", "_range", "_first", "_tie", "_before", "_n", "_cuts", "_h", "_deal", "_block", "_again"])
    key = F.col(id_col)
    go = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 2)
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in rows.columns])
    again = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), key, content), 2)

    ids = rows.select(key)
    total = ids.count()
    n_parts = partitions or min(MAX_PARTITIONS, max(shuffle_partitions(spark), math.ceil(total / 100_000)))
    n_ranges = min(MAX_RANGES, max(1, math.ceil(total / n_shards / ROWS_A_TASK)))
    part = F.pmod(F.xxhash64(F.lit(seed + 2), key), F.lit(n_parts)).cast("int")

    # narrow and pre-aggregated: one row for each identifier, so repeated rows meet here as a count
    narrow = scratch.save(
        ids.groupBy(key.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.pmod(F.xxhash64(F.lit(seed + 2), "_id"), F.lit(n_parts)).cast("int").alias("_vp"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_id"), 2).alias("_go"),
            "_n",
        ),
        "narrow",
    )
    sizes = [0] * n_parts
    for r in narrow.groupBy("_vp").agg(F.sum("_n").alias("n")).collect():  # at most MAX_PARTITIONS rows
        sizes[r["_vp"]] = r["n"]
    quota = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix(sizes, quota, seed)

    ends = matrix.cumsum(axis=1)[:, :-1] if n_shards > 1 else np.zeros((n_parts, 0), np.int64)
    cuts = spark.createDataFrame(
        [(p, [int(x) for x in row]) for p, row in enumerate(ends)], "_vp int, _ends array<long>"
    )
    # the last place before each cut: shard = number of cuts at or before a row's place in its partition
    order = Window.partitionBy("_vp").orderBy("_go")
    placed = (
        narrow.groupBy("_vp", "_go").agg(F.sum("_n").alias("_n"))
        .withColumn("_to", F.sum("_n").over(order))
        .withColumn("_from", F.col("_to") - F.col("_n"))
        .join(F.broadcast(cuts), "_vp")
    )
    first = F.size(F.filter("_ends", lambda e: e <= F.col("_from")))
    last = F.size(F.filter("_ends", lambda e: e <= F.col("_to") - 1))
    placed = scratch.save(
        placed.select("_vp", "_go", "_n", "_from", "_ends", first.alias("_first"), last.alias("_last")).select(
            "_vp", "_go", "_n", "_first", "_last",
            F.when(F.col("_first") < F.col("_last"), F.transform("_ends", lambda e: e - F.col("_from"))).alias("_ends"),
        ),
        "placed",
    )
    # thresholds: for each partition the hash from which on each shard holds; at most MAX_PARTITIONS x n_shards values
    starts = placed.groupBy("_vp", "_last").agg(F.min("_go").alias("_go")).select(
        "_vp", F.struct("_go", F.col("_last").alias("_shard")).alias("_cut")
    )
    table = starts.groupBy("_vp").agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    ties = scratch.save(placed.where(F.col("_first") < F.col("_last")).select("_vp", "_go", "_ends"), "ties")

    marked = rows.withColumn("_vp", part).withColumn("_go", go)
    marked = marked.join(F.broadcast(table), "_vp")
    by_cut = F.filter("_cuts", lambda c: c["_go"] <= F.col("_go"))
    plain = marked.withColumn("shard", F.element_at(by_cut, -1)["_shard"].cast("int")).drop("_cuts")
    shard_sizes = {s: q for s, q in enumerate(quota)}
    if not ties.isEmpty():
        # at most one tie for each cut, so the table is bounded; only rows of such ties are ordered by content
        t = F.broadcast(ties.withColumnRenamed("_ends", "_tie"))
        marked = plain.join(t, ["_vp", "_go"], "left")
        tied = _ranked(marked.where(F.col("_tie").isNotNull()).withColumn("_h", content), scratch)
        tied = tied.withColumn("shard", F.size(F.filter("_tie", lambda e: e <= F.col("_n"))).cast("int")).drop("_n", "_tie")
        plain = marked.where(F.col("_tie").isNull()).drop("_tie").unionByName(tied)

    spread = plain.drop("_vp", "_go").withColumn("_again", again).withColumn(
        "_range", F.floor(F.col("_again") / F.lit(_SPAN / n_ranges)).cast("int")
    )
    place = Window.partitionBy("shard", "_range").orderBy("_again")
    if n_ranges == 1:
        out = spread.withColumn("slot", F.row_number().over(place).cast("long") - 1)
        return out.drop("_again", "_range")
    # how many rows each range of a shard holds: bounded by n_shards x MAX_RANGES
    held = scratch.save(spread.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n")), "ranges")
    run = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("shard", "_range", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"))
    out = spread.withColumn("_n", F.row_number().over(place).cast("long") - 1)
    out = out.join(F.broadcast(offsets), ["shard", "_range"])
    return out.withColumn("slot", F.col("_before") + F.col("_n")).drop("_again", "_range", "_before", "_n")
