"""Overlap joins between boxes of the same image, by a tree of cells, and between masks, by segments of pixel rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.functions.boxes import Corners, corners, crowd_overlap, iou
from tessera.operators.grouping import broadcast_if_small
from tessera.operators.sweep import cut_rows
from tessera.session import stage

LOAD = 256  # boxes of both sides that one cell may hold before it is split
DEPTH = 12  # the finest cells are 1/4096 of the space that the box corners of an image span
STRIP = 64  # pixel rows of a strip in which the bands of masks meet, at most
BLOCK = 1024  # boxes of one cell, too large to be split, that meet the other side in one task


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def _same(keys: Sequence[str], a: str, b: str):
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def _finest(value, low, span):
    """Number of the finest cell along one side; values outside the spanned space count to its edge."""
    cell = F.floor((value - low) * F.lit(float(1 << DEPTH)) / span)
    return F.coalesce(F.least(F.greatest(cell, F.lit(0)), F.lit((1 << DEPTH) - 1)), F.lit(0)).cast("int")


def _crowded(left: DataFrame, right: DataFrame, keys: Sequence[str], load: int, counted: DataFrame | None = None) -> DataFrame | None:
    """Split cells (keys, level, cx, cy, root) of all images with more boxes than a cell may hold; None without such images.

    The keys are counted first, those of ``counted`` for ``left`` where it is given, and only boxes
    of images that may be crowded are looked at.  A cell is split while its load is above the limit
    and its quarters are not smaller than its boxes, as each box would then only be copied.
    """
    rows = (left if counted is None else counted).select(*keys).unionByName(right.select(*keys))
    full = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > load).select(*keys), "full")
    if full.isEmpty():
        return None
    columns = [*keys, "x", "y", "w", "h"]
    boxes = left.select(columns).unionByName(right.select(columns)).join(broadcast_if_small(full), list(keys), "left_semi")
    span = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    roots = boxes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("_ox"), F.min("y").alias("_oy"), span.alias("_span"))
    roots = stage(roots.where((F.col("n") > load) & (F.col("_span") > 0)).drop("n"), "crowded")
    if roots.isEmpty():
        return None
    placed = boxes.join(broadcast_if_small(roots), list(keys)).select(
        *keys, "_ox", "_oy", "_span", _finest(F.col("x"), F.col("_ox"), F.col("_span")).alias("gx"), _finest(F.col("y"), F.col("_oy"), F.col("_span")).alias("gy"),
        F.greatest("w", "h").alias("extent"),
    )
    fine = placed.groupBy(*keys, "_ox", "_oy", "_span", "gx", "gy").agg(F.count(F.lit(1)).alias("n"), F.sum("extent").alias("extent"))
    levels = fine.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1))))
    shift = F.expr(f"cast(power(2, {DEPTH} - level) as int)")
    cells = levels.groupBy(*keys, "_ox", "_oy", "_span", "level", F.floor(F.col("gx") / shift).cast("int").alias("cx"), F.floor(F.col("gy") / shift).cast("int").alias("cy"))
    loads = cells.agg(F.sum("n").alias("n"), F.sum("extent").alias("extent"))
    quarter = F.col("_span") / F.pow(F.lit(2.0), F.col("level") + 1)
    split = loads.where((F.col("level") == 0) | ((F.col("n") > load) & (quarter * F.col("n") >= F.col("extent"))))
    return stage(split.select(*keys, "_ox", "_oy", "_span", "level", "cx", "cy", ((F.col("n") > load) & (quarter * F.col("n") >= F.col("extent"))).alias("split")), "split-cells")


def _descend(df: DataFrame, prefix: str, keys: Sequence[str], split: DataFrame | None, depth: int, pixel: float) -> DataFrame:
    """One row per leaf cell (_level, _cx, _cy) that the box touches, with the finest cell (_gx, _gy) of its corner."""
    zero = F.lit(0)
    if split is None:
        return df.withColumns({"_level": zero, "_cx": zero, "_cy": zero, f"_{prefix}gx": zero, f"_{prefix}gy": zero})
    root = split.where("level = 0").select(*keys, "_ox", "_oy", "_span")
    rows = df.join(broadcast_if_small(root), list(keys), "left")
    for axis, size, low in (("x", "w", "_ox"), ("y", "h", "_oy")):
        near, far = F.col(f"{prefix}{axis}"), F.col(f"{prefix}{axis}") + F.col(f"{prefix}{size}") + F.lit(pixel)
        first, last = _finest(near, F.col(low), F.col("_span")), _finest(far, F.col(low), F.col("_span"))
        rows = rows.withColumn(f"_{prefix}g{axis}", first).withColumn(f"_to{axis}", F.greatest(first, last))
    rows = rows.drop("_ox", "_oy", "_span").withColumns({"_level": zero, "_cx": zero, "_cy": zero})
    for level in range(depth):
        here = split.where((F.col("level") == level) & F.col("split")).select(*keys, F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.lit(level).alias("_level"), F.lit(True).alias("_split"))
        rows = rows.join(broadcast_if_small(here), [*keys, "_level", "_cx", "_cy"], "left")
        size = 1 << (DEPTH - level - 1)
        for axis in "xy":
            own = F.col(f"_c{axis}")
            low = F.greatest(2 * own, F.floor(F.col(f"_{prefix}g{axis}") / size).cast("int"))
            high = F.least(2 * own + 1, F.floor(F.col(f"_to{axis}") / size).cast("int"))
            rows = rows.withColumn(f"_c{axis}", F.explode(F.when(F.col("_split"), F.sequence(low, high)).otherwise(F.array(own))))
        rows = rows.withColumn("_level", F.when(F.col("_split"), level + 1).otherwise(F.col("_level"))).drop("_split")
    return rows.drop("_tox", "_toy")


def overlap_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str], pixel: float = 0.0, load: int = LOAD, block: int = BLOCK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Pairs of overlapping boxes with equal ``keys``; columns get the prefixes ``a_`` and ``b_``.

    An image with up to ``load`` boxes is one cell.  Others are quartered again and again by
    counted load, whatever the unit of their coordinates, and both sides meet in the leaves.
    A pair is reported only by the leaf of the top-left corner of the common area, so no
    duplicate removal is needed.  A leaf that stays above ``block`` boxes, as its boxes lie on
    each other, is dealt to several tasks by its right side.  ``counted`` holds the rows of
    ``left`` and maybe more, for the first count, where they are cheaper to read.
    """
    keys = list(keys)
    split = _crowded(left, right, keys, load, counted)
    depth = 0 if split is None else (split.where("split").agg(F.max("level")).first()[0] or 0) + 1  # DEPTH at most
    a = _descend(_prefixed(left, keys, "a_"), "a_", keys, split, depth, pixel)
    b = _descend(_prefixed(right, keys, "b_"), "b_", keys, split, depth, pixel)
    cell = [*keys, "_level", "_cx", "_cy"]
    if split is not None:
        dealt = b.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_parts")).where("_parts > 1")
        dealt = broadcast_if_small(stage(dealt, "dealt"))
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        a = a.join(dealt, cell, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
        own = [c for c, kind in b.dtypes if c.startswith("b_") and "map<" not in kind]  # not a random number: a task that is run again must deal alike
        chosen = F.pmod(F.xxhash64(*own), parts).cast("int")
        b = b.join(dealt, cell, "left").withColumn("_part", chosen).drop("_parts")
        cell = [*cell, "_part"]
    joined = a.join(b, cell)
    p, q = corners("a_"), corners("b_")
    x1, y1 = F.greatest(p.x1, q.x1), F.greatest(p.y1, q.y1)
    meets = (F.least(p.x2, q.x2) + pixel > x1) & (F.least(p.y2, q.y2) + pixel > y1)
    size = F.expr(f"cast(power(2, {DEPTH} - _level) as int)")
    home = (F.floor(F.greatest("_a_gx", "_b_gx") / size) == F.col("_cx")) & (F.floor(F.greatest("_a_gy", "_b_gy") / size) == F.col("_cy"))
    return joined.filter(meets & home).drop(*[c for c in joined.columns if c.startswith("_")])


def iou_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("image_id",),
    pixel: float = 0.0,
    eps: float = 0.0,
    load: int = LOAD,
) -> DataFrame:
    """Overlapping pairs with their ``iou``; pairs that do not touch have IoU 0 and are left out."""
    pairs = overlap_pairs(left, right, keys, pixel, load)
    return pairs.withColumn("iou", iou(corners("a_"), corners("b_"), pixel, eps))


def crowd_iou_join(dets: DataFrame, truths: DataFrame, keys: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """Like ``iou_join``, but overlap with a crowd box is measured against the detection's area only."""
    a: Corners = corners("a_")
    b: Corners = corners("b_")
    measure = F.when(F.col("b_iscrowd") == 1, crowd_overlap(a, b)).otherwise(iou(a, b))
    return overlap_pairs(dets, truths, keys, counted=counted).withColumn("iou", measure)


def _bands(runs: DataFrame) -> DataFrame:
    """Runs with ``rows``: consecutive rows of ``runs`` that go on one pixel row below with the same start and end become one.

    Only neighbours of a batch are put together, so nothing is shuffled; a mask may stay in several bands.
    """
    same = [c for c in runs.columns if c != "row"]
    schema = StructType([*runs.schema.fields, StructField("rows", LongType())])

    def merge(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            row = batch.column("row").to_numpy(zero_copy_only=False)
            begins = np.ones(n, bool)
            begins[1:] = row[1:] != row[:-1] + 1
            for c in same:
                column = batch.column(c)
                differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True)
                begins[1:] |= differs.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(begins)
            taken = batch.take(pa.array(first))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.diff(first, append=n))], names=schema.names)

    return runs.mapInArrow(merge, schema)


def mask_overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """(keys, a_mask, b_mask, common, a_area, b_area) in pixels of masks given as run rows (keys, mask_id, row, start, end), end exclusive.

    A side may give its equal runs of consecutive rows as one band with their number in ``rows``;
    without that column they are put together before anything is written or moved.  Bands meet
    in strips of rows, about as high as the mean band and so single rows for ragged masks, and
    in a crowded strip on the same segment of it, so a row of any length is many tasks; the
    pixels of all parts are summed per pair.
    """
    keys = list(keys)

    def areas(runs: DataFrame, name: str) -> DataFrame:
        pixels = (F.col("end") - F.col("start")) * F.col("rows")
        return runs.groupBy(*keys, F.col("mask_id").alias(f"{name}_mask")).agg(F.sum(pixels).alias(f"{name}_area"))

    columns = [*keys, "row", "start", "end", "mask_id"]

    def banded(side: DataFrame, number: int) -> DataFrame:
        given = side.where("end > start")
        if "rows" in side.columns:
            return given.where("rows > 0").select(*columns, F.lit(number).alias("side"), F.col("rows").cast("long").alias("rows"))
        return _bands(given.select(*columns, F.lit(number).alias("side")))

    runs = stage(banded(left, 0).unionByName(banded(right, 1)), "runs")
    mean = runs.agg(F.avg("rows")).first()[0] or 1.0
    height = min(STRIP, 1 << int(math.log2(mean)))
    last = F.col("row") + F.col("rows") - 1
    strips = runs.withColumn("_strip", F.explode(F.sequence(F.floor(F.col("row") / height), F.floor(last / height))))
    placed = strips.withColumns({"_top": F.greatest(F.col("row").cast("long"), F.col("_strip") * height), "_low": F.least(last + 1, (F.col("_strip") + 1) * height)})
    cut = cut_rows(placed, [*keys, "_strip"])
    a, b = [
        cut.where(F.col("side") == side).select(
            *keys, "_strip", "_segment", F.col("mask_id").alias(f"{name}_mask"), *[F.col(c).alias(f"{name}_{to}") for c, to in (("start", "s"), ("end", "e"), ("_top", "t"), ("_low", "l"))]
        )
        for side, name in ((0, "a"), (1, "b"))
    ]
    wide = F.least("a_e", "b_e") - F.greatest("a_s", "b_s")
    high = F.least("a_l", "b_l") - F.greatest("a_t", "b_t")
    met = a.join(b, [*keys, "_strip", "_segment"]).filter((wide > 0) & (high > 0)).withColumn("common", wide * high)
    common = met.groupBy(*keys, "a_mask", "b_mask").agg(F.sum("common").alias("common"))
    return common.join(areas(runs.where("side = 0"), "a"), [*keys, "a_mask"]).join(areas(runs.where("side = 1"), "b"), [*keys, "b_mask"])


def mask_iou_join(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("image_id",)) -> DataFrame:
    """IoU of the instance masks that share a pixel, both sides given as run rows (see ``mask_overlaps``)."""
    sized = mask_overlaps(left, right, keys)
    return sized.select(*keys, "a_mask", "b_mask", (F.col("common") / (F.col("a_area") + F.col("b_area") - F.col("common"))).alias("iou"))
