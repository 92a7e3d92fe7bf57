"""Repeatable pseudo-random columns: a text hash of the seed and the row's key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_digest(seed: str, *parts: Column) -> Column:
    """md5 of ``seed|part|...`` as hex text; the same on any cluster and in any engine."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts]))


def unit_random(seed: str, *parts: Column) -> Column:
    """Double in [0, 1) from the first 48 bits of the digest."""
    return F.conv(F.substring(hex_digest(seed, *parts), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def uniform(seed: str, low: float | Column, high: float | Column, *parts: Column) -> Column:
    low = F.lit(low) if not isinstance(low, Column) else low
    high = F.lit(high) if not isinstance(high, Column) else high
    return low + (high - low) * unit_random(seed, *parts)


def pick_index(seed: str, n: int | Column, *parts: Column) -> Column:
    """Integer in [0, n)."""
    n = F.lit(n) if not isinstance(n, Column) else n
    return F.floor(unit_random(seed, *parts) * n).cast("long")
