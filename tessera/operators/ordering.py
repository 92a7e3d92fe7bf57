"""Exact ranks, running aggregates and splits without a single-task window.

A plain ``Window.orderBy`` without (or with a hot) partition key sends all its
rows to one task.  Here rows are range-partitioned on the full order, so a hot
key is spread over many slices; every slice is processed alone and only one
total per slice is carried on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.seeded import hex_digest
from tessera.session import stage

_MONOTONIC_BITS = 33  # monotonically_increasing_id: partition number above bit 33, row below


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


RowWork = Callable[[DataFrame], DataFrame]


def sliced(
    df: DataFrame, order: Sequence[str | Column], name: str = "sliced", then: RowWork | None = None
) -> DataFrame:
    """Range-partition by ``order`` and store with ``slice_no`` and ``slice_pos``.

    ``order`` must be a total order.  Slices ascend along it; positions count
    from 0 inside each slice.  ``then`` is costly row-wise work (it may drop
    rows, but not shuffle): it runs after the exchange, spread over all slices
    and once only, while the bounds are sampled from the cheap rows before it.
    """
    order = [_col(c) for c in order]
    spread = df.repartitionByRange(*order)
    marked = (
        (spread if then is None else then(spread))
        .sortWithinPartitions(*order)
        .withColumn("slice_no", F.spark_partition_id())
        .withColumn("slice_pos", F.monotonically_increasing_id().bitwiseAND((1 << _MONOTONIC_BITS) - 1))
    )
    return stage(marked, name)


def dense_id(
    df: DataFrame, order: Sequence[str | Column], name: str = "id", start: int = 0, then: RowWork | None = None
) -> DataFrame:
    """Consecutive ids from ``start`` along the total order ``order``, after the row-wise work ``then``.

    One range shuffle; the offsets table has one row per slice, so the
    broadcast is bounded by the number of shuffle partitions.
    """
    rows = sliced(df, order, "dense-id", then)
    before = Window.orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("slice_no")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("slice_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        rows.join(F.broadcast(offsets), "slice_no")
        .withColumn(name, (F.col("_offset") + F.col("slice_pos") + start).cast("long"))
        .drop("slice_no", "slice_pos", "_offset")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    name: str = "running",
) -> DataFrame:
    """Running sums and maxima per group, current row included, any group size.

    Each group is cut into slices; a slice takes the total of the group's
    earlier slices from a carry table.  A carry row exists only where a group
    crosses a slice edge, so there are fewer carry rows than slices and the
    broadcast stays small however many groups there are.
    """
    sums, maxima = sums or {}, maxima or {}
    keys = list(keys)
    order = [_col(c) for c in order]
    rows = sliced(df, [*keys, *order], name)

    totals = [F.sum(c).alias(f"_carry_{n}") for n, c in sums.items()]
    totals += [F.max(c).alias(f"_carry_{n}") for n, c in maxima.items()]
    per_slice = rows.groupBy(*keys, "slice_no").agg(*totals)
    group = Window.partitionBy(*keys).orderBy("slice_no")
    earlier = group.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *keys,
        "slice_no",
        F.row_number().over(group).alias("_nth"),
        *[F.sum(f"_carry_{n}").over(earlier).alias(f"_carry_{n}") for n in sums],
        *[F.max(f"_carry_{n}").over(earlier).alias(f"_carry_{n}") for n in maxima],
    ).filter("_nth > 1").drop("_nth")

    local = Window.partitionBy(*keys, "slice_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select(
        "*",
        *[F.sum(c).over(local).alias(n) for n, c in sums.items()],
        *[F.max(c).over(local).alias(n) for n, c in maxima.items()],
    )
    on = [within[k].eqNullSafe(carry[k]) for k in keys] + [within["slice_no"] == carry["slice_no"]]
    joined = within.join(F.broadcast(carry), on, "left")
    skip = {*sums, *maxima, "slice_no", "slice_pos"}
    return joined.select(
        *[within[c] for c in within.columns if c not in skip],
        *[(within[n] + F.coalesce(carry[f"_carry_{n}"], F.lit(0))).alias(n) for n in sums],
        *[F.greatest(within[n], carry[f"_carry_{n}"]).alias(n) for n in maxima],
    )


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rank"
) -> DataFrame:
    """1-based position inside each group, exact for groups of any size."""
    return running(df, keys, order, sums={name: F.lit(1).cast("long")}, name="rank")


def batch_index(
    df: DataFrame, order: Sequence[str | Column], size: int, drop_last: bool = False, name: str = "batch"
) -> DataFrame:
    """Number rows in batches of ``size`` along ``order``; ``drop_last`` leaves out a partial tail."""
    rows = dense_id(df, order, "_row")
    out = rows.withColumn(name, F.floor(F.col("_row") / size).cast("long"))
    if drop_last:
        n = rows.count()
        out = out.filter(F.col("_row") < (n // size) * size)
    return out.drop("_row")


def hash_cut(df: DataFrame, id_col: str, seed: str, cuts: Sequence[tuple[str, int]], name: str) -> DataFrame:
    """Label rows by their exact rank in a seeded hash order.

    ``cuts`` lists (label, first rank after the label) in ascending order; rows
    past the last cut get NULL.  Counts per hash bucket (65,536 at most) decide
    almost every row in place; rows are ranked only in the few buckets that a
    cut goes through, so nothing else is shuffled.
    """
    hashed = df.withColumn("_h", hex_digest(seed, F.col(id_col)))
    hashed = hashed.withColumn("_bucket", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    spans = counts.select("_bucket", (F.sum("_n").over(upto) - F.col("_n")).alias("_lo"), F.sum("_n").over(upto).alias("_hi"))

    inside = F.lit(False)
    for _, cut in cuts:
        inside = inside | ((F.col("_lo") < cut) & (F.col("_hi") > cut))
    spans = spans.withColumn("_split_bucket", inside)
    marked = hashed.join(F.broadcast(spans), "_bucket")

    def label(rank: Column) -> Column:
        out = F.lit(None).cast("string")
        for text, cut in reversed(cuts):
            out = F.when(rank < cut, F.lit(text)).otherwise(out)
        return out

    whole = marked.filter(~F.col("_split_bucket")).withColumn(name, label(F.col("_lo")))
    by_bucket = Window.partitionBy("_bucket").orderBy("_h", id_col)
    cut_through = marked.filter("_split_bucket").withColumn(
        name, label(F.col("_lo") + F.row_number().over(by_bucket) - 1)
    )
    drop = ["_h", "_bucket", "_lo", "_hi", "_split_bucket"]
    return whole.drop(*drop).unionByName(cut_through.drop(*drop))
