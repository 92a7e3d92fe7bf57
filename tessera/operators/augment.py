"""Augmentation of annotations: seeded parameters as columns, then plain arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import polygons as pg
from tessera.functions.boxes import clip
from tessera.functions.seeded import pick_index, uniform, unit_random
from tessera.functions.text import copy_name
from tessera.operators.sampling import pick_partners


@dataclass(frozen=True)
class AffineRange:
    """Ranges of the random affine: degrees, share of the size, scale around 1, shear degrees."""

    degrees: float = 10.0
    translate: float = 0.1
    scale: float = 0.1
    shear: float = 10.0


def expand_augmentations(images: DataFrame, copies: int, style: str = "suffix") -> DataFrame:
    """``copies`` rows per image with ``copy_no`` and the copy's file name; no shuffle."""
    rows = images.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return rows.withColumn("copy_name", copy_name(F.col("file_name"), F.col("copy_no"), style))


def affine_matrix(width: Column, height: Column, ranges: AffineRange, seed: str, *key: Column) -> dict[str, Column]:
    """Columns m0 .. m5 of [[m0, m1, m2], [m3, m4, m5]]: rotation and scale about the origin, shear, translation."""

    def draw(name: str, half: float, centre: float = 0.0) -> Column:
        return uniform(f"{seed}:{name}", centre - half, centre + half, *key)

    angle = F.radians(draw("angle", ranges.degrees))
    scale = draw("scale", ranges.scale, 1.0)
    a, b = scale * F.cos(angle), scale * F.sin(angle)
    shear_x = F.tan(F.radians(draw("shear_x", ranges.shear)))
    shear_y = F.tan(F.radians(draw("shear_y", ranges.shear)))
    return {
        "m0": a - shear_y * b,
        "m1": b + shear_y * a,
        "m2": draw("translate_x", ranges.translate) * width,
        "m3": shear_x * a - b,
        "m4": shear_x * b + a,
        "m5": draw("translate_y", ranges.translate) * height,
    }


M = tuple(f"m{i}" for i in range(6))


def with_affine(images: DataFrame, ranges: AffineRange, seed: str) -> DataFrame:
    """Images (or copies) with their matrix; the draw depends on the image and the copy number only."""
    key = [F.col("image_id")] + ([F.col("copy_no")] if "copy_no" in images.columns else [])
    return images.withColumns(affine_matrix(F.col("width"), F.col("height"), ranges, seed, *key))


def affine_boxes(annotations: DataFrame, frames: DataFrame, min_size: float | None = None) -> DataFrame:
    """Enclosing boxes of the four transformed corners, cut to the image.

    ``frames`` comes from ``with_affine``; with ``copy_no`` every copy of an
    image gets its own boxes.  ``min_size`` drops boxes that became too small.
    """
    extra = [c for c in ("copy_no",) if c in frames.columns]
    j = annotations.join(frames.select("image_id", *extra, F.col("width").alias("_iw"), F.col("height").alias("_ih"), *M), "image_id")
    x1, y1 = F.col("x"), F.col("y")
    x2, y2 = F.col("x") + F.col("w"), F.col("y") + F.col("h")
    corners = [(x1, y1), (x2, y2), (x1, y2), (x2, y1)]
    xs = [F.col("m0") * x + F.col("m1") * y + F.col("m2") for x, y in corners]
    ys = [F.col("m3") * x + F.col("m4") * y + F.col("m5") for x, y in corners]
    iw, ih = F.col("_iw").cast("double"), F.col("_ih").cast("double")
    moved = j.withColumns(
        {
            "_x1": clip(F.least(*xs), 0.0, iw),
            "_y1": clip(F.least(*ys), 0.0, ih),
            "_x2": clip(F.greatest(*xs), 0.0, iw),
            "_y2": clip(F.greatest(*ys), 0.0, ih),
        }
    )
    out = moved.withColumns(
        {"x": F.col("_x1"), "y": F.col("_y1"), "w": F.col("_x2") - F.col("_x1"), "h": F.col("_y2") - F.col("_y1")}
    ).select(*annotations.columns, *extra)
    return out if min_size is None else out.filter((F.col("w") >= min_size) & (F.col("h") >= min_size))


def _with_rings(df: DataFrame, rings: Column) -> DataFrame:
    """Replace ``segmentation`` by ``rings`` and drop rows without any."""
    others = [c for c in df.columns if c != "segmentation"]
    # explode of a one-element array: the filter then reads the result instead of computing it again
    return df.select(*others, F.explode(F.array(rings)).alias("segmentation")).filter(F.size("segmentation") > 0)


def clip_polygons_to_image(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Annotations with polygons cut to their image; those without a polygon left go."""
    j = annotations.join(images.select("image_id", F.col("width").alias("_iw"), F.col("height").alias("_ih")), "image_id")
    rings = pg.clip_rings(F.col("segmentation"), F.lit(0.0), F.lit(0.0), F.col("_iw") - 1.0, F.col("_ih") - 1.0)
    return _with_rings(j, rings).select(*annotations.columns)


def affine_polygons(annotations: DataFrame, frames: DataFrame) -> DataFrame:
    """Vertices clamped to the image, moved by the matrix, rings cut to the image.

    The area is recomputed (box of the first ring) only where it is missing or 0.
    """
    extra = [c for c in ("copy_no",) if c in frames.columns]
    j = annotations.join(frames.select("image_id", *extra, F.col("width").alias("_iw"), F.col("height").alias("_ih"), *M), "image_id")
    m = tuple(F.col(c) for c in M)
    moved = _with_rings(j, pg.clip_rings(F.col("segmentation"), F.lit(0.0), F.lit(0.0), F.col("_iw") - 1.0, F.col("_ih") - 1.0, matrix=m))
    _, _, bw, bh = pg.enclosing_box(pg.to_points(F.col("segmentation")[0]))
    if "area" in annotations.columns:
        area = F.when(F.coalesce("area", F.lit(0.0)) == 0, bw * bh).otherwise(F.col("area"))
    else:
        area = bw * bh
    kept = [c for c in annotations.columns if c != "area"]
    return moved.select(*kept, *extra, area.alias("area"))


# ---------------------------------------------------------------- mosaic and mixup


def _resized(images: DataFrame, height: int, width: int, id_name: str) -> DataFrame:
    scale = F.least(F.lit(float(height)) / F.col("height"), F.lit(float(width)) / F.col("width"))
    return images.select(F.col("image_id").alias(id_name), scale.alias("scale"), "width", "height").select(
        id_name,
        "scale",
        (F.col("width") * F.col("scale")).cast("int").alias("rw"),
        (F.col("height") * F.col("scale")).cast("int").alias("rh"),
    )


def mosaic_layout(images: DataFrame, height: int, width: int, seed: str) -> DataFrame:
    """(image_id, slot, source_id, scale, dx, dy): four images around a random centre of a canvas twice the size."""
    centre = images.select(
        "image_id",
        uniform(f"{seed}:yc", 0.5 * height, 1.5 * height, F.col("image_id")).cast("int").alias("yc"),
        uniform(f"{seed}:xc", 0.5 * width, 1.5 * width, F.col("image_id")).cast("int").alias("xc"),
    )
    partners = pick_partners(images, 3, f"{seed}:partner").select("image_id", F.col("nth").alias("slot"), F.col("partner").alias("source_id"))
    own = images.select("image_id", F.lit(0).alias("slot"), F.col("image_id").alias("source_id"))
    placed = own.unionByName(partners).join(_resized(images, height, width, "source_id"), "source_id").join(centre, "image_id")
    left, top = F.col("slot").isin(0, 2), F.col("slot").isin(0, 1)
    # the corner of the whole small image on the canvas, whether or not it is cut there
    dx = F.when(left, F.col("xc") - F.col("rw")).otherwise(F.col("xc"))
    dy = F.when(top, F.col("yc") - F.col("rh")).otherwise(F.col("yc"))
    return placed.select("image_id", "slot", "source_id", "scale", dx.alias("dx"), dy.alias("dy"))


def mosaic_annotations(annotations: DataFrame, images: DataFrame, height: int, width: int, seed: str = "mosaic") -> DataFrame:
    """Boxes of the four images scaled, shifted and cut to the 2 * height by 2 * width canvas."""
    layout = mosaic_layout(images, height, width, seed)
    boxes = annotations.select(F.col("image_id").alias("source_id"), "ann_id", "category_id", "x", "y", "w", "h")
    j = layout.join(boxes, "source_id")

    def at(value: Column, shift: str, limit: int) -> Column:
        return clip(F.col("scale") * value + F.col(shift), 0.0, float(limit))

    x1, x2 = at(F.col("x"), "dx", 2 * width), at(F.col("x") + F.col("w"), "dx", 2 * width)
    y1, y2 = at(F.col("y"), "dy", 2 * height), at(F.col("y") + F.col("h"), "dy", 2 * height)
    return j.select("image_id", "slot", "source_id", "ann_id", "category_id", x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))


def mixup_annotations(
    annotations: DataFrame,
    images: DataFrame,
    height: int,
    width: int,
    jitter: tuple[float, float] = (0.5, 1.5),
    seed: str = "mixup",
) -> DataFrame:
    """The image's own boxes and those of a random labelled partner, jittered, maybe mirrored, shifted and cut.

    ``origin`` tells the two apart.  ``height`` and ``width`` are the input size
    that own boxes already live in.
    """
    labelled = images.join(annotations.select("image_id"), "image_id", "left_semi")
    picks = pick_partners(images, 1, f"{seed}:partner", pool=labelled).select("image_id", F.col("partner").alias("source_id"))
    key = F.col("image_id")
    drawn = picks.withColumns(
        {"jit": uniform(f"{seed}:jitter", jitter[0], jitter[1], key), "flip": unit_random(f"{seed}:flip", key) > 0.5}
    )
    drawn = drawn.withColumns({"ow": (F.col("jit") * width).cast("int"), "oh": (F.col("jit") * height).cast("int")})

    def offset(name: str, size: str, target: int) -> Column:
        spare = F.col(size) - target
        return F.when(spare > 0, pick_index(f"{seed}:{name}", spare, key)).otherwise(F.lit(0))

    drawn = drawn.withColumns({"ox": offset("x", "ow", width), "oy": offset("y", "oh", height)})
    sized = drawn.join(_resized(images, height, width, "source_id").select("source_id", "scale"), "source_id")
    boxes = annotations.select(F.col("image_id").alias("source_id"), "ann_id", "category_id", "x", "y", "w", "h")
    j = sized.join(boxes, "source_id").withColumn("_r", F.col("scale") * F.col("jit"))

    def scaled(value: Column, limit: str) -> Column:
        return clip(value * F.col("_r"), 0.0, F.col(limit).cast("double"))

    bx1, bx2 = scaled(F.col("x"), "ow"), scaled(F.col("x") + F.col("w"), "ow")
    j = j.withColumns(
        {
            "_x1": F.when(F.col("flip"), F.col("ow") - bx2).otherwise(bx1),
            "_x2": F.when(F.col("flip"), F.col("ow") - bx1).otherwise(bx2),
            "_y1": scaled(F.col("y"), "oh"),
            "_y2": scaled(F.col("y") + F.col("h"), "oh"),
        }
    )
    x1, x2 = (clip(F.col(c) - F.col("ox"), 0.0, float(width)) for c in ("_x1", "_x2"))
    y1, y2 = (clip(F.col(c) - F.col("oy"), 0.0, float(height)) for c in ("_y1", "_y2"))
    mixed = j.select(
        "image_id", F.lit("partner").alias("origin"), "ann_id", "category_id", x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h")
    )
    own = annotations.select("image_id", F.lit("own").alias("origin"), "ann_id", "category_id", "x", "y", "w", "h")
    return own.unionByName(mixed)
