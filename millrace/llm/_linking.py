"""Clusters of similar items: candidate groups, pair verification, distributed union-find. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.llm._base import Scratch

#: Members of a crowded group that one task compares with all others of it.
BLOCK = 128


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, component`` for each node of ``edges(a, b)``; the component is the smallest id that links reach.

    Alternating large-star and small-star rounds: each moves neighbours to the smallest one, until nothing changes.
    Minima are pre-aggregated, so a hub costs one row a task; the join back is an inner sort-merge join, which adaptive
    execution splits at a hub. Repeated edges are dropped once a round, and what tells whether it changed anything is
    observed while it is written. The number of rounds grows with the logarithm of the longest path.
    """

    def save(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark")
        out = scratch.save(df.observe(seen, F.count(F.lit(1)).alias("n"), mark), "edges")
        return out, (seen.get["n"], seen.get["mark"])

    now, last = save(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    )
    while last[0]:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .where("u != v")
        )
        # every edge now points down; small star hangs a node's lower neighbours on the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        before, old = last, now
        now, last = save(small)
        scratch.drop(old)
        if last == before:
            break
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def link_groups(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    compatible: Callable[[Column, Column, Column | None], Column],
    scratch: Scratch,
    star_rounds: int = 2,
    central: Column | None = None,
    merge_groups: bool = False,
    detail: DataFrame | None = None,
    linked: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Components (``id, component``) of the links among candidates: ids that share a ``key`` of ``members``.

    ``members`` has ``key, id, size``, each (key, id) once. ``verify`` takes distinct pairs ``a < b`` and returns those
    that are links. Every pair of a group that could matter is verified, but pairs inside a component found already
    cannot change the result, so dense groups never expand into all pairs: in each star round the members of a group
    are compared with one leader only, components are formed, and groups that lie inside one component are done. What
    is left, pairs of one group in different components with compatible sizes, is then compared in full. ``compatible``
    takes both sizes, and there also the key, so that a pair of many groups can be shown in the first of them only.
    Leaders are chosen by hash; where ``central`` is given, the first round takes the member with the least of it.

    ``merge_groups``: of groups with the same members one is enough (where ``size`` does not depend on the key).
    ``detail(id, detail)`` and ``linked``: what the last comparison looks at, and the whole test of a link. It then runs
    inside the join, so only links are made, each in the first group that its ids share, and a crowded group is dealt
    over as many tasks as it has ``BLOCK`` members.
    """
    members = members.select("key", "id", "size")
    if merge_groups:
        marks = members.groupBy("key").agg(F.bit_xor(F.xxhash64("id")).alias("m"), F.count(F.lit(1)).alias("n"))
        one = marks.where("n > 1").groupBy("m", "n").agg(F.min("key").alias("key")).select("key")
        members = members.join(one, "key", "left_semi")
    work = scratch.save(members.withColumn("label", F.col("id")), "members")
    scratch.clean()
    links = None
    components = None

    def pairs(left: DataFrame) -> DataFrame:
        return left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    def settle(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        own = scratch.save(verify(found), "links")
        every = own if links is None else links.unionByName(own)
        return every, scratch.save(connected_components(every, scratch), "components")

    for k in range(star_rounds):
        chance = F.xxhash64(F.lit(k), "id")
        rank = F.struct(central.alias("c"), chance.alias("h")) if k == 0 and central is not None else chance
        lead = work.groupBy("key").agg(F.min_by(F.struct("id", "size", "label"), rank).alias("lead"))
        star = (
            work.join(lead, "key")
            .where((F.col("label") != F.col("lead.label")) & compatible(F.col("size"), F.col("lead.size"), None))
            .select(F.col("id").alias("x"), F.col("lead.id").alias("y"))
        )
        links, components = settle(pairs(star))
        labels = components.select("id", F.col("component").alias("_c"))
        moved = work.drop("label").join(labels, "id", "left").withColumn("label", F.coalesce("_c", "id")).drop("_c")
        open_ = moved.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
        left = scratch.save(moved.join(open_.select("key"), "key", "left_semi"), "members")
        scratch.drop(work)
        scratch.clean()
        work = left
        if work.isEmpty():
            return components
    p, q = (work.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "size", "label")]) for side in "xy")
    apart = (F.col("label_x") < F.col("label_y")) & compatible(F.col("size_x"), F.col("size_y"), F.col("key"))
    ends = [F.col("id_x").alias("x"), F.col("id_y").alias("y")]
    if detail is None:
        return settle(pairs(p.join(q, "key").where(apart).select(*ends)))[1]
    known = work.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys")).join(detail, "id")
    known = scratch.save(known, "known")
    scratch.clean()
    deals = work.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("deals"))
    p, q = (d.join(known.select(*[F.col(c).alias(f"{c}_{side}") for c in known.columns]), f"id_{side}") for d, side in ((p, "x"), (q, "y")))
    p = p.join(deals, "key").withColumn("deal_x", F.pmod(F.xxhash64("id_x"), "deals").cast("int")).drop("deals")
    q = q.join(deals, "key").withColumn("deal_y", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    q = q.withColumnRenamed("key", "key_y")
    first = F.get(F.array_intersect("keys_x", "keys_y"), F.lit(0)) == F.col("key")
    # as the join's own condition: a filter after it would see every pair as a row
    meet = (F.col("key") == F.col("key_y")) & (F.col("deal_x") == F.col("deal_y"))
    met = p.join(q, meet & apart & first & linked(F.col("detail_x"), F.col("detail_y")))
    own = scratch.save(pairs(met.select(*ends)), "links")
    return scratch.save(connected_components(links.unionByName(own), scratch), "components")
