"""Writes to keyed tables as set operations: upsert and delete, partial and conditional updates, model aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changelog import DELETE


def latest(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], *, op: str = "__op") -> DataFrame:
    """The last change of each key, by a total order. ``max_by`` is pre-aggregated on the map side, so a key with many
    changes reaches its task as one row for each map task."""
    rest = [c for c in changes.columns if c not in keys]
    # of changes that tie in the sequence a delete comes first: a key change writes -U and +U at one moment
    last_op = [(-F.col(f"`{op}`")).alias("_op_last")] if op in changes.columns else []
    order = F.struct(*[F.col(f"`{c}`") for c in sequence], *last_op, F.lit(0).alias("_any"))
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_last")
    return changes.groupBy(*keys).agg(last).select(*keys, "_last.*").select(changes.columns)


def apply_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], base: DataFrame | None = None, *, op: str = "__op") -> DataFrame:
    """The table after a change set: of each key the last change, unless that deletes; other keys as in ``base``."""
    last = latest(changes, keys, sequence, op=op)
    kept = last.where(F.col(op) != DELETE).drop(op)
    if base is None:
        return kept
    untouched = base.join(last.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(kept.select(base.columns))


def partial_update(base: DataFrame, delta: DataFrame, keys: Sequence[str], *, sequence: Sequence[str] = (), op: str = "__op", present: str | None = None) -> DataFrame:
    """``base`` after an update of the columns that ``delta`` has; keys it lacks are inserted with nulls elsewhere.

    A column takes its last value in the delta, null included. Where records hold different fields, ``present`` names
    a column with the array of fields that are there; an absent field leaves the value alone. Deletes (``__op`` 1) end
    a key; changes after a delete start from an empty row. Without ``sequence`` each key occurs once in the delta.
    """
    meta = {op, present, *sequence}
    fields = [c for c in base.columns if c not in keys and c in delta.columns]
    unknown = [c for c in delta.columns if c not in base.columns and c not in meta]
    if unknown:
        raise ValueError(f"columns that the table does not have: {unknown}")
    d = delta if op in delta.columns else delta.withColumn(op, F.lit(0))
    order = F.struct(*[F.col(f"`{c}`") for c in sequence]) if sequence else F.struct(F.lit(0).alias("_one"))
    d = d.withColumn("_order", order)
    alive = F.col(op) != DELETE

    def there(c: str) -> Column:
        return alive & F.array_contains(F.col(present), c) if present else alive

    def last(c: str) -> Column:
        value = F.struct(F.col("_order").alias("at"), F.col(f"`{c}`").alias("v"))
        return F.max_by(F.when(there(c), value), F.when(there(c), F.col("_order"))).alias(f"_new_{c}")

    # if the last value of a column is not after the last delete, no value is: one aggregate tells all
    merged = d.groupBy(*keys).agg(
        F.max(F.when(alive, F.col("_order"))).alias("_alive"), F.max(F.when(F.col(op) == DELETE, F.col("_order"))).alias("_deleted"), *map(last, fields)
    )
    both = base.join(merged, list(keys), "full_outer")
    fresh = F.col("_deleted").isNotNull()

    def after(at: Column) -> Column:
        return F.coalesce(~fresh | (at > F.col("_deleted")), F.lit(False))

    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.col(f"`{c}`"))
        else:
            old = F.when(~fresh, F.col(f"`{c}`"))
            new = F.col(f"_new_{c}") if c in fields else None
            out.append((F.when(new.isNotNull() & after(new["at"]), new["v"]).otherwise(old) if new is not None else old).alias(c))
    return both.where(~fresh | after(F.col("_alive"))).select(*out)


def conditional_update(base: DataFrame, delta: DataFrame, keys: Sequence[str], condition: str, *, sequence: Sequence[str] = ()) -> DataFrame:
    """``base`` after changes that count only where their ``condition`` column is at least the old value; new keys are
    inserted. Of changes to one key the greatest value wins, then the last."""
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in delta.columns]), F.struct(F.col(f"`{condition}`"), *[F.col(f"`{c}`") for c in sequence]))
    won = delta.groupBy(*keys).agg(best.alias("_d")).select(*keys, "_d")
    both = base.withColumn("_there", F.lit(True)).join(won, list(keys), "full_outer")
    newer = F.col("_d").isNotNull() & (
        F.col("_there").isNull() | F.coalesce(F.col(f"_d.`{condition}`") >= F.col(f"`{condition}`"), F.col(f"`{condition}`").isNull())
    )
    out = []
    for c in base.columns:
        if c in keys or c not in delta.columns:
            out.append(F.col(f"`{c}`"))
        else:
            out.append(F.when(newer, F.col(f"_d.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c))
    return both.select(*out)


def append(base: DataFrame, rows: DataFrame) -> DataFrame:
    """``base`` with rows added by column name; columns they lack are null, unknown ones are an error."""
    unknown = [c for c in rows.columns if c.lower() not in {b.lower() for b in base.columns}]
    if unknown:
        raise ValueError(f"columns that the table does not have: {unknown}")
    return base.unionByName(rows, allowMissingColumns=True).select(base.columns)


def conform(base: DataFrame, schema: T.StructType) -> DataFrame:
    """``base`` in another version of its schema: added columns are null, dropped ones are not read."""
    have = {c.lower() for c in base.columns}
    return base.select(
        *[F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def aggregate_load(rows: DataFrame, keys: Sequence[str], functions: Mapping[str, str], *, sequence: Sequence[str] = ()) -> DataFrame:
    """Rows with equal keys merged column by column, as an aggregate table does on load.

    SUM, MAX, MIN; REPLACE (last value) and REPLACE_IF_NOT_NULL (last value there is); BITMAP_UNION (exact distinct
    counts, as a count), HLL_UNION (a sketch), PERCENTILE_UNION (median estimate). Sums are decimals where the column
    is a double, so they do not depend on the order of addition.
    """
    order = F.struct(*[F.col(f"`{c}`") for c in sequence]) if sequence else F.lit(0)
    kinds = dict(rows.dtypes)

    def merged(name: str, how: str) -> Column:
        c = F.col(f"`{name}`")
        if how == "SUM":
            return F.sum(c.cast("decimal(38,6)")).cast("double") if kinds[name] == "double" else F.sum(c)
        if how == "MAX":
            return F.max(c)
        if how == "MIN":
            return F.min(c)
        if how == "REPLACE":
            return F.max_by(F.struct(c.alias("v")), order)["v"]
        if how == "REPLACE_IF_NOT_NULL":
            return F.max_by(c, F.when(c.isNotNull(), order))
        if how == "HLL_UNION":
            return F.hll_sketch_agg(c)
        if how == "PERCENTILE_UNION":
            return F.percentile_approx(c, 0.5)
        raise ValueError(f"no load function {how}")

    plain = {c: f for c, f in functions.items() if f != "BITMAP_UNION"}
    bitmaps = [c for c, f in functions.items() if f == "BITMAP_UNION"]
    out = rows.groupBy(*keys).agg(*[merged(c, f).alias(c) for c, f in plain.items()]) if plain else rows.select(*keys).distinct()
    for c in bitmaps:
        # groups without a value, and groups with null keys, count too
        counted = bitmap_count(bitmap_state(rows, keys, c), keys).select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], "distinct_count")
        same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        out = out.join(counted, same, "left").withColumn(c, F.coalesce("distinct_count", F.lit(0).cast("long")))
        out = out.drop("distinct_count", *[f"_k{i}" for i in range(len(keys))])
    return out.select(*keys, *functions)


#: Load functions whose stored value is a state that further loads merge into.
STATEFUL = ("BITMAP_UNION", "HLL_UNION", "PERCENTILE_UNION")


def aggregate_state(rows: DataFrame, keys: Sequence[str], functions: Mapping[str, str], *, sequence: Sequence[str] = ()) -> DataFrame:
    """One load as mergeable state, a row for each key: BITMAP_UNION as an array of (bucket, bits), which grows with the
    values of one key by a bit each; HLL_UNION and PERCENTILE_UNION as sketches; REPLACE with its place in the order;
    the others as they are."""
    kinds = dict(rows.dtypes)
    order = F.struct(*[F.col(f"`{c}`") for c in sequence]) if sequence else F.struct(F.lit(0).alias("_any"))
    aggs = []
    for name, how in functions.items():
        c = F.col(f"`{name}`")
        if how == "SUM":
            got = F.sum(c.cast("decimal(38,6)")) if kinds[name] == "double" else F.sum(c)
        elif how in ("MAX", "MIN"):
            got = F.max(c) if how == "MAX" else F.min(c)
        elif how in ("REPLACE", "REPLACE_IF_NOT_NULL"):
            taken = F.lit(True) if how == "REPLACE" else c.isNotNull()
            got = F.max(F.when(taken, F.struct(order.alias("at"), c.alias("v"))))
        elif how == "HLL_UNION":
            got = F.hll_sketch_agg(c)
        elif how == "PERCENTILE_UNION":
            got = F.kll_sketch_agg_double(c.cast("double"))
        elif how == "BITMAP_UNION":
            continue
        else:
            raise ValueError(f"no load function {how}")
        aggs.append(got.alias(name))
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    for name, how in functions.items():
        if how == "BITMAP_UNION":
            out = _with_bitmap(out, bitmap_state(rows, keys, name), keys, name)
    return out.select(*keys, *functions)


def _with_bitmap(out: DataFrame, state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    packed = state.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("_bits"))
    packed = packed.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], "_bits")
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    empty = F.array().cast(packed.schema["_bits"].dataType)
    return out.join(packed, same, "left").withColumn(name, F.coalesce("_bits", empty)).drop("_bits", *[f"_k{i}" for i in range(len(keys))])


def merge_states(states: DataFrame, keys: Sequence[str], functions: Mapping[str, str]) -> DataFrame:
    """States of several loads as one."""
    how = {"SUM": F.sum, "MAX": F.max, "MIN": F.min, "REPLACE": F.max, "REPLACE_IF_NOT_NULL": F.max, "HLL_UNION": F.hll_union_agg, "PERCENTILE_UNION": F.kll_merge_agg_double}
    out = states.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[how[f](f"`{c}`").alias(c) for c, f in functions.items() if f in how])
    for name, f in functions.items():
        if f == "BITMAP_UNION":
            blocks = states.select(*keys, F.explode(f"`{name}`").alias("_b")).select(*keys, "_b.bucket", "_b.bits")
            out = _with_bitmap(out, merge_bitmaps(blocks, keys), keys, name)
    return out.select(*keys, *functions)


def finish_states(states: DataFrame, functions: Mapping[str, str]) -> DataFrame:
    """What a reader sees of merged state: distinct counts, distinct estimates, medians, last values."""

    def shown(name: str, how: str) -> Column:
        c = F.col(f"`{name}`")
        if how == "BITMAP_UNION":
            return F.aggregate(c, F.lit(0).cast("long"), lambda acc, b: acc + F.bitmap_count(b["bits"]))
        if how == "HLL_UNION":
            return F.hll_sketch_estimate(c)
        if how == "PERCENTILE_UNION":
            return F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(0.5)))
        if how in ("REPLACE", "REPLACE_IF_NOT_NULL"):
            return c["v"]
        return c.cast("double") if how == "SUM" and dict(states.dtypes)[name].startswith("decimal") else c

    return states.select(*[shown(c, functions[c]).alias(c) if c in functions else F.col(f"`{c}`") for c in states.columns])


def bitmap_state(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mergeable exact-distinct state: one fixed-size bitmap for each key and block of values."""
    c = F.col(f"`{column}`").cast("long")
    return (
        rows.where(c.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(c).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("bits"))
    )


def merge_bitmaps(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_count(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    merged = merge_bitmaps(state, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("distinct_count"))


def hll_count(sketches: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(column)).alias("distinct_estimate"))


def quality_gate(rows: DataFrame, good: Column, max_filter_ratio: float) -> DataFrame:
    """Rows that pass; fails when more than the given share does not. One aggregate over the condition's columns."""
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if(~F.coalesce(good, F.lit(False)))).first()
    if n and bad / n > max_filter_ratio:
        raise ValueError(f"too many filtered rows: {bad} of {n}")
    return rows.where(good)
