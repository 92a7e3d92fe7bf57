"""Non-maximum suppression and candidate scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.boxes import Corners, corners, iou
from tessera.operators.greedy import greedy_dropped
from tessera.operators.grouping import split_by_size
from tessera.operators.overlap import overlap_pairs

ARRAY_ROWS = 512  # candidates of one group that are handled as one array


def _box(s: Column) -> Corners:
    return Corners(s["x"], s["y"], s["x"] + s["w"], s["y"] + s["h"])


def _suppress_arrays(dets: DataFrame, keys: list[str], threshold: float, pixel: float) -> DataFrame:
    """Groups of bounded size: one shuffle, then a fold over the ranked boxes inside the JVM."""
    ranked = dets.select(*keys, F.struct((-F.col("score")).alias("_k"), "det_id", *[c for c in dets.columns if c not in {"det_id", *keys}]).alias("_d"))
    kept_type = ranked.schema["_d"].dataType.simpleString()
    start = F.array().cast(f"array<{kept_type}>")

    def add(kept: Column, d: Column) -> Column:
        clash = F.exists(kept, lambda k: iou(_box(k), _box(d), pixel) > threshold)
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(d)))

    kept = ranked.groupBy(*keys).agg(F.aggregate(F.array_sort(F.collect_list("_d")), start, add).alias("_kept"))
    out = kept.select(*keys, F.explode("_kept").alias("_d")).select(*keys, "_d.*")
    return out.select(*dets.columns)


def _self_clash(threshold: float, pixel: float) -> Column:
    """Whether a box's IoU with its equal exceeds ``threshold``: it is 1, 0 without an area, NaN with an endless one.

    The IoU itself, written out over computed columns, is too much code to be compiled.
    """
    if threshold < 0:
        return F.lit(True)
    own = corners()
    width, height = own.x2 - own.x1 + F.lit(pixel), own.y2 - own.y1 + F.lit(pixel)
    common = F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))
    return (width + height).isNotNull() & (common > 0 if threshold < 1 else common >= float("inf"))


def _suppress_rounds(dets: DataFrame, keys: list[str], threshold: float, pixel: float) -> DataFrame:
    """Groups of any size: conflict graph by the grid join, then greedy rounds over the whole table.

    Of equal boxes only the first can survive, where a box clashes with its
    equal at all: not at thresholds from 1 on, nor without an area.  Such a box
    clashes with no other either and is kept.
    """
    self_clash = _self_clash(threshold, pixel)
    free, dets = dets.filter(~self_clash), dets.filter(self_clash)
    firsts = dets.groupBy(*keys, "x", "y", "w", "h").agg(
        F.max(F.struct("score", (-F.col("det_id")).alias("_d"))).alias("_first")
    )
    unique = firsts.select(*keys, "x", "y", "w", "h", F.col("_first.score").alias("score"), (-F.col("_first._d")).alias("det_id"))
    pairs = overlap_pairs(unique, unique, keys, pixel)
    earlier = (F.col("a_score") > F.col("b_score")) | (
        (F.col("a_score") == F.col("b_score")) & (F.col("a_det_id") < F.col("b_det_id"))
    )
    clash = iou(corners("a_"), corners("b_"), pixel) > threshold
    edges = pairs.filter(earlier & clash).select(F.col("a_det_id").alias("first"), F.col("b_det_id").alias("later"))
    dropped = greedy_dropped(edges, "nms")
    kept = unique.select("det_id")
    if dropped is not None:
        kept = kept.join(dropped.select(F.col("later").alias("det_id")), "det_id", "left_anti")
    return dets.join(kept, "det_id", "left_semi").select(*dets.columns).unionByName(free)


def _suppress(dets: DataFrame, keys: list[str], threshold: float, pixel: float, array_rows: int) -> DataFrame:
    small, large = split_by_size(dets, keys, array_rows)
    kept = _suppress_arrays(small, keys, threshold, pixel)
    if large is not None:
        kept = kept.unionByName(_suppress_rounds(large, keys, threshold, pixel))
    return kept


def nms_per_class(
    dets: DataFrame, threshold: float, min_score: float | None = None, pixel: float = 1.0, array_rows: int = ARRAY_ROWS
) -> DataFrame:
    """Keep the best boxes per image and class; a box goes when its IoU with a kept one exceeds ``threshold``.

    ``min_score`` is exclusive.  Equal scores are taken in det_id order.
    """
    if min_score is not None:
        dets = dets.filter(F.col("score") > min_score)
    return _suppress(dets, ["image_id", "category_id"], threshold, pixel, array_rows)


def nms_agnostic(
    dets: DataFrame, threshold: float, min_score: float | None = None, pixel: float = 0.0, array_rows: int = ARRAY_ROWS
) -> DataFrame:
    """The same over all classes of an image; ``min_score`` is inclusive."""
    if min_score is not None:
        dets = dets.filter(F.col("score") >= min_score)
    return _suppress(dets, ["image_id"], threshold, pixel, array_rows)


# ---------------------------------------------------------------- candidates

# Head strides, without and with the extra coarse level.
STRIDES = (8, 16, 32)
STRIDES_COARSE = (8, 16, 32, 64)


def grid_cells(spark, height: int, width: int, strides: tuple[int, ...] = STRIDES) -> DataFrame:
    """(cell, grid_x, grid_y, stride) in head output order: stride by stride, row by row.

    One row per output cell of one image, a size fixed by the model input.
    """
    out = None
    first = 0
    for s in strides:
        rows, cols = height // s, width // s
        level = spark.range(rows * cols).select(
            (F.col("id") + first).alias("cell"),
            (F.col("id") % cols).cast("int").alias("grid_x"),
            F.floor(F.col("id") / cols).cast("int").alias("grid_y"),
            F.lit(s).alias("stride"),
        )
        out = level if out is None else out.unionByName(level)
        first += rows * cols
    return out


def decode_grid(raw: DataFrame, height: int, width: int, strides: tuple[int, ...] = STRIDES) -> DataFrame:
    """Raw head output (cell, tx, ty, tw, th) to centre boxes in input pixels."""
    grid = grid_cells(raw.sparkSession, height, width, strides)
    s = F.col("stride")
    return (
        raw.join(F.broadcast(grid), "cell")
        .withColumn("cx", (F.col("tx") + F.col("grid_x")) * s)
        .withColumn("cy", (F.col("ty") + F.col("grid_y")) * s)
        .withColumn("bw", F.exp("tw") * s)
        .withColumn("bh", F.exp("th") * s)
        .drop("tx", "ty", "tw", "th", "grid_x", "grid_y", "stride")
    )


def score_candidates(candidates: DataFrame, threshold: float, per_class: bool = False) -> DataFrame:
    """Objectness times class score.

    Best class per candidate with an inclusive threshold, or with ``per_class``
    one row per class with an exclusive threshold.
    """
    if per_class:
        rows = candidates.select("*", F.posexplode("class_scores").alias("class_idx", "_s"))
        return (
            rows.withColumn("score", F.col("objectness") * F.col("_s"))
            .filter(F.col("score") > threshold)
            .drop("_s", "class_scores")
        )
    best = F.array_max("class_scores")
    return (
        candidates.withColumn("class_idx", (F.array_position("class_scores", best) - 1).cast("int"))
        .withColumn("score", F.col("objectness") * best)
        .filter(F.col("score") >= threshold)
        .drop("class_scores")
    )


# ---------------------------------------------------------------- predictions per image


def cap_per_image(dets: DataFrame, k: int, order: list[Column], keys: tuple[str, ...] = ("image_id",), name: str | None = None) -> DataFrame:
    """First ``k`` predictions per image in the given order; Spark cuts to ``k`` before the shuffle."""
    rank = name or "_rank"
    out = dets.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)
    return out if name else out.drop(rank)


def filter_confidence(dets: DataFrame, threshold: float) -> DataFrame:
    return dets.filter(F.col("score") >= threshold)


def top1_class(scores: DataFrame) -> DataFrame:
    """Best class per image from rows (image_id, class_idx, score); the lower index wins a tie."""
    best = scores.groupBy("image_id").agg(F.max(F.struct("score", (-F.col("class_idx")).alias("_neg"))).alias("_b"))
    return best.select("image_id", (-F.col("_b._neg")).alias("class_idx"), F.col("_b.score").alias("score"))
