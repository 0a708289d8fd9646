"""Lookup joins against a dimension table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A dimension is broadcast when its plan's size estimate, or else a count, stays below this.
BROADCAST_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[tuple[str, str]] | Sequence[str],
    how: str = "inner",
    *,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """All matches of each fact's keys in the dimension (equality, one to many), ``inner`` or ``left``.

    The dimension is broadcast while the optimizer's size estimate for it is under ``limit``; a larger one is joined by
    a shuffle, which adaptive execution may still turn into a broadcast or split at hot keys. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("a lookup join is inner or left")
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    if not pairs:
        raise ValueError("a lookup join has keys")
    f, d = facts.alias("f"), dim.alias("d")
    side = F.broadcast(d) if estimated_bytes(dim) <= limit else d
    on = None
    for a, b in pairs:
        one = F.col(f"f.`{a}`") == F.col(f"d.`{b}`")
        on = one if on is None else on & one
    shared = {c.lower() for c in facts.columns}
    cols = [F.col(f"f.`{c}`") for c in facts.columns] + [F.col(f"d.`{c}`") for c in dim.columns if c.lower() not in shared]
    return f.join(side, on, how).select(*cols)


class CachedDimension:
    """A dimension that is read again once its time to live has passed: for use inside ``foreachBatch``."""

    def __init__(self, load: Callable[[], DataFrame], ttl_ms: int = 5_000, clock: Callable[[], float] = time.monotonic):
        self.load, self.ttl, self.clock = load, ttl_ms / 1000, clock
        self._at: float | None = None
        self._df: DataFrame | None = None

    def get(self) -> DataFrame:
        now = self.clock()
        if self._df is None or now - self._at >= self.ttl:
            self._df, self._at = self.load(), now
        return self._df


def partial_lookup(facts: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]] | Sequence[str], how: str = "inner") -> DataFrame:
    """A lookup join that first narrows the dimension to keys that the facts have: the set form of probing key by key."""
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    probes = facts.select(*[F.col(f"`{a}`").alias(b) for a, b in pairs]).distinct()
    return lookup_join(facts, dim.join(probes, [b for _, b in pairs], "left_semi"), pairs, how)
