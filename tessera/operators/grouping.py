"""Grouping helpers that stay safe when one group holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import rank_in_group

GROUP_ROWS = 10_000  # largest group that one task may hold as an array
BROADCAST_ROWS = 10_000  # largest label or class table that is broadcast


def split_by_size(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups up to ``limit`` rows, and rows of larger groups (None when there are none).

    The count reads the key columns only and combines map-side.
    """
    keys = list(keys)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys)
    if large.isEmpty():
        return df, None
    return df.join(large, keys, "left_anti"), df.join(large, keys, "left_semi")


def collect_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, limit: int = GROUP_ROWS
) -> DataFrame:
    """Ordered arrays of ``value`` per group: (keys, part, name).

    A group of up to ``limit`` rows is one row with part 0.  A larger group
    becomes several consecutive parts, so no array grows without bound and no
    row is lost.
    """
    keys = list(keys)
    small, large = split_by_size(df, keys, limit)
    rows = small.select(*keys, F.lit(0).cast("long").alias("part"), F.struct(*order, value).alias("_v"))
    if large is not None:
        ranked = rank_in_group(large.select(*dict.fromkeys([*keys, *order, value])), keys, order, "_rank")
        rows = rows.unionByName(
            ranked.select(
                *keys, F.floor((F.col("_rank") - 1) / limit).cast("long").alias("part"), F.struct(*order, value).alias("_v")
            )
        )
    collected = rows.groupBy(*keys, "part").agg(F.array_sort(F.collect_list("_v")).alias("_vs"))
    return collected.select(*keys, "part", F.transform("_vs", lambda v: v[value]).alias(name))


def bounded_rows(df: DataFrame, what: str, limit: int = BROADCAST_ROWS) -> list:
    """Rows of a table that must be small (labels, classes); more than ``limit`` rows is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows")
    return rows


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the table has at most ``limit`` rows; otherwise the plan decides."""
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df
