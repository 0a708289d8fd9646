"""N-gram Jaccard self-join with prefix filters under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._base import Scratch, maybe_broadcast
from millrace.llm._linking import link_groups
from millrace.llm._shingles import SLICE, shingle_sets

#: Documents in the sample that shows which shingles are frequent, and how many of them a frequent one is in. At most
#: SAMPLE x (shingles of a document) / FREQUENT shingles are frequent. They only come last in the orders: the sample
#: steers work, never results.
SAMPLE = 4_096
FREQUENT = 8


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = _signed(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _extended(n: int, percent: int) -> tuple[int, int]:
    """(length, need): of two sets that reach the threshold, one of size ``n``, the first ``length`` elements of it hold
    at least ``need`` that are also among the first of the other, by the other's own length.

    With an overlap of o, the first n - o + e elements of both share e or more. Here e is a tenth of the size, 1 at
    least, and the partner may be smaller by the threshold.
    """
    least = -(-percent * n // 100)
    return n - least + max(1, n // 10), max(1, least // 10)


def _prints(frequent: np.ndarray, percent: int, k: int, whole: bool):
    """Rows (doc_id, n, node, need, cold, hot). cold: the rare shingles of the extended prefix under the hash order, or,
    if ``whole``, all rare ones; hot: all frequent ones. node: a hash of the set. need: how many of the rare ones must
    be met elsewhere, as frequent ones in the prefix count as met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, SLICE):
                batch = big.slice(at, SLICE)
                sizes, nodes, needs, colds, hots = [], [], [], [], []
                for s in shingle_sets(batch.column(1).to_pylist(), k):
                    place = np.searchsorted(frequent, s)
                    known = np.zeros(len(s), bool)
                    inside = place < len(frequent)
                    known[inside] = frequent[place[inside]] == s[inside]
                    cold, hot = s[~known], s[known]
                    sizes.append(len(s))
                    nodes.append(xxhash.xxh64_intdigest(s.tobytes(), len(s)) - (1 << 63))
                    hots.append(hot)
                    length, need = _extended(len(s), percent)
                    needs.append(need - min(len(hot), max(0, length - len(cold))))
                    colds.append(cold if whole else cold[:length])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(needs, pa.int64()), _lists(colds), _lists(hots)],
                    names=["doc_id", "text_h", "n", "node", "need", "cold", "hot"],
                )

    return run


_SCHEMA = "doc_id long, text_h long, n long, node long, need long, cold array<long>, hot array<long>"


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, text_h`` (a hash of the text, null as empty).

    A document's set is its distinct k-word shingles (A-Z lowered; words split at ASCII white space). Two documents link
    when 100 x intersection >= ``percent`` x union; the component is the smallest identifier that links reach.

    Candidates pass prefix filters under three global orders of all shingles, each exact on its own:

    1. hash order: a document leaves unless its extended prefix meets enough shingles of other sets' extended prefixes;
       the frequent shingles come last;
    2. rarest first (exact document frequency among those left), ties by hash: pairs come from these prefixes only,
       shingles of one document need no posting at all, and a shared one counts only at a place in both sets that
       leaves room for the overlap;
    3. rarest-or-not first, then another hash: a pair must also share a prefix shingle here before it is verified.

    Verification intersects whole sets. Equal sets are one node throughout, so exact copies never meet; dense groups
    are linked by ``link_groups`` without forming all pairs. Shingles are 64-bit hashes.

    Null and empty texts have no shingles and link with nothing. A row with a null identifier keeps its set size, has
    a null component and links nothing. Rows that share an identifier each take part with their own text. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("text_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    known = base.where(F.col("doc_id").isNotNull())

    every = max(1, docs.count() // SAMPLE)
    none = np.zeros(0, np.uint64)
    sample = known.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(every)) == 0)
    seen = sample.mapInArrow(_prints(none, percent, k, True), _SCHEMA).select(F.explode("cold").alias("t"))
    often = seen.groupBy("t").count().where(F.col("count") >= FREQUENT).select("t").toPandas()["t"]
    frequent = np.sort(often.to_numpy(np.int64).view(np.uint64))

    prints = scratch.save(base.mapInArrow(_prints(frequent, percent, k, False), _SCHEMA), "prints")
    linkable = prints.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))

    # order 1: rare shingles of the extended prefix in one narrow exchange
    rare = linkable.select("doc_id", "node", "need", F.explode("cold").alias("t"))
    # counted on the map side and joined, so that a common shingle is split as any skewed key of a join
    common = rare.groupBy("t").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("t")
    met = rare.join(common, "t", "left_semi")
    enough = met.groupBy("doc_id", "node", "need").agg(F.count(F.lit(1)).alias("met")).where("met >= need").select("node")
    live = enough.union(linkable.where("need <= 0").select("node")).distinct()
    nodes = linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    live = scratch.save(nodes.join(live, "node", "left_semi"), "live")
    wide, prints = prints, scratch.save(prints.select("doc_id", "text_h", "n", "node", "hot"), "narrow")
    scratch.drop(wide)
    linkable = prints.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))

    # order 2: document frequency of the rare shingles of what is left; one text for each distinct set
    chosen = known.join(maybe_broadcast(live.select("doc_id").distinct()), "doc_id", "left_semi")
    whole = scratch.save(chosen.mapInArrow(_prints(frequent, percent, k, True), _SCHEMA).select("node", "cold"), "whole")
    full = whole.select("node", F.explode("cold").alias("t"))
    counted = full.join(full.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "t")
    cold = counted.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("df", "t"))).alias("cold"))
    hots = linkable.groupBy("node").agg(F.first("hot").alias("hot"))
    sets = live.join(hots, "node").join(cold, "node", "left")
    empty = F.array().cast("array<long>")
    ranked = F.coalesce(F.transform("cold", lambda c: c["t"]), empty)
    tokens = F.concat(ranked, "hot")
    prefix = (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1).cast("int")
    quota = prefix - (F.col("n") - F.size(tokens)).cast("int")  # shingles of this document alone come first

    def other(c: Column) -> Column:
        by_hash = F.transform(c, lambda x: F.struct(F.xxhash64(F.lit(3), x).alias("h"), x.alias("t")))
        return F.transform(F.array_sort(by_hash), lambda x: x["t"])

    sets = sets.select("node", "n", tokens.alias("tokens"), quota.alias("quota"), F.concat(other(ranked), "hot").alias("third"))
    sets = scratch.save(
        sets.where("quota > 0").select(
            "node", "n", "tokens", F.slice("tokens", 1, F.col("quota")).alias("first"),
            F.slice("third", 1, F.col("quota")).alias("third"),
        ),
        "sets",
    )
    scratch.drop(whole)
    posted = sets.select(F.col("node").alias("id"), "n", F.size("tokens").alias("_s"), F.posexplode("first").alias("_p", "key"))
    place = (F.col("n") - F.col("_s") + F.col("_p")).alias("place")
    posted = posted.select("id", "key", F.struct("n", place).alias("size"))
    members = posted.join(
        posted.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("key"),
        "key", "left_semi",
    )

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"), F.col("third").alias("pa"))
        b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"), F.col("third").alias("pb"))
        both = pairs.join(a, "a").join(b, "b").where(F.arrays_overlap("pa", "pb"))
        common = F.size(F.array_intersect("ta", "tb")).cast("long")
        return both.where((100 + percent) * common >= percent * (F.col("na") + F.col("nb"))).select("a", "b")

    def fits(x: Column, y: Column, key: Column | None) -> Column:
        """Sizes within the threshold, and, were this the first shared shingle, enough left in both for the overlap.
        The first one that a pair shares passes, so no pair is lost where later ones fail."""
        sizes = F.lit(100) * F.least(x["n"], y["n"]) >= F.lit(percent) * F.greatest(x["n"], y["n"])
        room = F.least(x["n"] - x["place"], y["n"] - y["place"])
        return sizes & (F.lit(100 + percent) * room >= F.lit(percent) * (x["n"] + y["n"]))

    # the fewer shingles of its own a set has, the more sets of its group it is near to
    linked = link_groups(members, verify, fits, scratch, star_rounds=3, central=F.col("size.place"))
    labelled = prints.select("doc_id", "text_h", "n", "node").join(linked.withColumnRenamed("id", "node"), "node", "left")
    labelled = labelled.select("doc_id", "text_h", "n", F.coalesce("component", "node").alias("label"))
    label = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("label"))
    lowest = labelled.where(label.isNotNull()).groupBy("label").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("c"))
    lowest = scratch.save(lowest.where("c > 1").select("label", "low"), "lowest")
    out = labelled.join(maybe_broadcast(lowest), "label", "left")
    linked_id = F.when(label.isNotNull(), F.coalesce("low", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), linked_id.alias("component_id"), "text_h")
