"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._base import BROADCAST_ROWS, Scratch, partitions, replacing

#: A Poisson count with a larger mean is the sum of independent ones with at most this mean.
MEAN_STEP = 16.0
#: Terms of the distribution function that are tabulated; beyond 64 a count with mean 16 has probability below 1e-18.
TERMS = 64
_HEX = 13  # hex digits of the hash that make a uniform number: 52 bits, exact in a double


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts, the same on every engine that has MD5."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    whole = F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**_HEX))


def poisson_table(mean: Column) -> Column:
    """The distribution function of a Poisson count at 0, 1, ... as an array."""
    terms = F.sequence(F.lit(1), F.lit(TERMS))
    state = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(terms, state, step)["cdf"]


def source_rates(
    docs: DataFrame,
    *,
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    budget: float = 1.0,
) -> DataFrame:
    """``source, rows, rate``: the mean repetitions that give each source its share of ``budget`` x all rows.

    ``weights`` maps sources to target shares (others get 0); without it a source's share is in proportion to
    rows ** temperature. Shares are normalised. The null source is a source like any other, named null in ``weights``
    by the key "".
    """
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        share = F.pow(F.col("rows").cast("double"), F.lit(float(temperature)))
    else:
        if any(w < 0 or not math.isfinite(w) for w in weights.values()):
            raise ValueError("weights are finite and not negative")
        pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
        share = F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce("source", F.lit(""))), F.lit(0.0)) if pairs else F.lit(0.0)
    # one row for each source from here on
    sizes = sizes.withColumn("share", share)
    whole = sizes.agg(F.sum("share").alias("shares"), F.sum("rows").alias("all_rows")).first()  # two numbers
    if not whole["shares"]:
        return sizes.select("source", "rows", F.lit(0.0).alias("rate"))
    rate = F.lit(float(budget)) * whole["all_rows"] * F.col("share") / F.lit(whole["shares"]) / F.col("rows")
    return sizes.select("source", "rows", rate.alias("rate"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    budget: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` replicated to target weights and shuffled globally: all columns plus ``copy`` and ``position``.

    A document's count is the inverse of a Poisson distribution function, with its source's mean rate, at a uniform
    number hashed from (seed, identifier, step); rates over 16 add up independent steps. It appears that often, with
    ``copy`` from 0. ``position`` is a hash of (seed, identifier, copy): rows go to the partition of their range of
    positions and are sorted there, so reading the partitions in order is one global random order. The count of a
    document depends on nothing but itself and its source's rate, so reruns and lost executors change nothing.

    The rate table (one row a source) is broadcast while it has at most 2,000,000 rows, which is counted, and else
    joined by a shuffle whose skewed partitions adaptive execution splits. One exchange moves the rows.

    Null sources are one source; null identifiers hash as one identifier; repeated rows get equal counts, each its own
    copies; null and long texts pass through. An empty table gives an empty result. Input columns named copy or
    position are replaced.
    """
    spark = docs.sparkSession
    docs = replacing(docs, ["copy", "position", "_rate", "_cdf", "_times", "_steps", "_source", "_part"])
    rates = Scratch(spark, "mix").save(
        source_rates(docs, source_col=source_col, weights=weights, temperature=temperature, budget=budget), "rates"
    )
    steps = F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN_STEP)).cast("int")
    table = rates.select(
        F.col("source").alias("_source"), steps.alias("_steps"), poisson_table(F.col("rate") / steps).alias("_cdf")
    )
    n = rates.limit(BROADCAST_ROWS + 1).count()
    table = F.broadcast(table) if n <= BROADCAST_ROWS else table
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))

    def draw(step: Column) -> Column:
        u = uniform(F.lit(seed), ident, step.cast("string"))
        return F.size(F.filter("_cdf", lambda c: c < u))

    times = F.aggregate(F.sequence(F.lit(1), F.col("_steps")), F.lit(0), lambda acc, k: acc + draw(k))
    parts = partitions(spark)
    where = F.conv(F.substring(F.col("position"), 1, _HEX), 16, 10).cast("double") / F.lit(float(16**_HEX))
    return (
        docs.join(table, F.col(source_col).cast("string").eqNullSafe(F.col("_source")))
        .withColumn("_times", times)
        .where(F.col("_times") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
        .withColumn("position", F.md5(F.concat_ws(":", F.lit(seed), ident, F.lit("copy"), F.col("copy").cast("string")).cast("binary")))
        .drop("_source", "_steps", "_cdf", "_times")
        .withColumn("_part", F.least(F.floor(where * parts), F.lit(parts - 1)).cast("int"))
        .repartitionById(parts, F.col("_part"))
        .sortWithinPartitions("position")
        .drop("_part")
    )


def mix_sql(temperature: float = 0.5, budget: float = 1.0, seed: str = "mix", columns: str = "doc_id, text, lang, source, n_chars") -> str:
    """The same rows in DuckDB SQL over a relation named docs, for rates of at most ``MEAN_STEP``."""
    return f"""
    sizes AS (SELECT source, count(*) AS n, power(count(*)::DOUBLE, {temperature!r}) AS share FROM docs GROUP BY source),
    whole AS (SELECT sum(share) AS shares, sum(n) AS all_rows FROM sizes),
    rates AS (SELECT source, {budget!r} * all_rows * share / shares / n AS rate FROM sizes, whole),
    k AS (SELECT unnest(range(0, {TERMS} + 1)) AS k),
    terms AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1.0)) AS p FROM rates, k WHERE rate > 0),
    cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
    u AS (SELECT docs.*, (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':1'), 1, {_HEX}))::BIGINT + 0.5)
          / {float(16**_HEX)!r} AS u FROM docs),
    counted AS (SELECT {", ".join(f"u.{c.strip()}" for c in columns.split(","))}, count(*) AS times FROM u JOIN cdf
        ON u.source IS NOT DISTINCT FROM cdf.source AND cdf.c < u.u GROUP BY ALL),
    copies AS (SELECT *, unnest(range(0, times)) AS copy FROM counted)"""
