"""Box operators that need the image size, and simple shape filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.boxes import clip


def normalise_boxes(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Adds the centre form (cx, cy, nw, nh) and the corner form (nx1 .. ny2) in [0, 1], and the image size."""
    j = annotations.join(images.select("image_id", "width", "height"), "image_id")
    x, y, w, h, iw, ih = (F.col(c) for c in ("x", "y", "w", "h", "width", "height"))
    return j.withColumns(
        {
            "cx": (2 * x + w) / (2 * iw),
            "cy": (2 * y + h) / (2 * ih),
            "nw": w / iw,
            "nh": h / ih,
            "nx1": x / iw,
            "ny1": y / ih,
            "nx2": (x + w) / iw,
            "ny2": (y + h) / ih,
        }
    )


def denormalise_boxes(boxes: DataFrame, integers: bool = False, y_first: bool = False) -> DataFrame:
    """Pixel box (px, py, pw, ph) from corners in [0, 1] and the image size.

    ``integers`` drops fractions; ``y_first`` reads the corners in (y, x) order.
    """
    a, b, c, d = (F.col(n) for n in ("nx1", "ny1", "nx2", "ny2"))
    if y_first:
        a, b, c, d = b, a, d, c
    out = {
        "px": a * F.col("width"),
        "py": b * F.col("height"),
        "pw": (c - a) * F.col("width"),
        "ph": (d - b) * F.col("height"),
    }
    if integers:
        out = {n: v.cast("int") for n, v in out.items()}
    return boxes.withColumns(out)


def clip_boxes(boxes: DataFrame, images: DataFrame, policy: str = "clamp") -> DataFrame:
    """Boxes cut to their image.

    ``clamp``: negative origins go to 0 and the far corner to the image edge;
    kept when the box had an area and the corners stay in order.  ``shift``:
    the origin moves to 0 without changing the size, what sticks out on the far
    side is cut, empty boxes go.
    """
    j = boxes.join(images.select("image_id", F.col("width").alias("_iw"), F.col("height").alias("_ih")), "image_id")
    zero = F.lit(0.0)
    x1, y1 = F.greatest("x", zero), F.greatest("y", zero)
    if policy == "clamp":
        x2 = F.least(F.col("_iw").cast("double"), x1 + F.greatest("w", zero))
        y2 = F.least(F.col("_ih").cast("double"), y1 + F.greatest("h", zero))
        kept = j.filter((F.col("w") * F.col("h") > 0) & (x2 >= x1) & (y2 >= y1))
        new = {"x": x1, "y": y1, "w": x2 - x1, "h": y2 - y1}
    elif policy == "shift":
        w = F.col("w") - F.greatest(x1 + F.col("w") - F.col("_iw"), zero)
        h = F.col("h") - F.greatest(y1 + F.col("h") - F.col("_ih"), zero)
        kept = j.filter((w > 0) & (h > 0))
        new = {"x": x1, "y": y1, "w": w, "h": h}
    else:
        raise ValueError("policy must be clamp or shift")
    return kept.withColumns(new).select(*boxes.columns)


def filter_box_scale(boxes: DataFrame, min_side: float, max_side: float) -> DataFrame:
    area = F.col("w") * F.col("h")
    return boxes.filter((area > min_side * min_side) & (area < max_side * max_side))


def prune_coco(annotations: DataFrame) -> DataFrame:
    """Training columns only, without crowd regions."""
    return annotations.filter(F.col("iscrowd") == 0).select("ann_id", "image_id", "category_id", "x", "y", "w", "h")


def letterbox_boxes(boxes: DataFrame, images: DataFrame, height: int, width: int) -> DataFrame:
    """Boxes scaled by r = min(height/h, width/w), with the ratio and the resized image size.

    Boxes whose smaller side is at most 1 after scaling go; when an image would
    lose all its boxes this way it keeps all of them.
    """
    frames = images.select(
        "image_id",
        F.least(F.lit(float(height)) / F.col("height"), F.lit(float(width)) / F.col("width")).alias("ratio"),
        F.col("height").alias("_ih"),
        F.col("width").alias("_iw"),
    )
    frames = frames.withColumn("resized_h", (F.col("_ih") * F.col("ratio")).cast("int")).withColumn(
        "resized_w", (F.col("_iw") * F.col("ratio")).cast("int")
    )
    scaled = boxes.join(frames.drop("_ih", "_iw"), "image_id").withColumns({c: F.col(c) * F.col("ratio") for c in "xywh"})
    thick = F.least("w", "h") > 1
    any_left = scaled.groupBy("image_id").agg(F.bool_or(thick).alias("_any"))
    return scaled.join(any_left, "image_id").filter(thick | ~F.col("_any")).drop("_any")


def unletterbox_boxes(boxes: DataFrame) -> DataFrame:
    """Back to original pixels with the stored ratio."""
    return boxes.withColumns({c: F.col(c) / F.col("ratio") for c in "xywh"})


def flip_boxes(boxes: DataFrame, images: DataFrame, horizontal, vertical=None) -> DataFrame:
    """Mirror boxes inside their image where the boolean columns ``horizontal`` / ``vertical`` hold."""
    vertical = F.lit(False) if vertical is None else vertical
    j = boxes.join(images.select("image_id", F.col("width").alias("_iw"), F.col("height").alias("_ih")), "image_id")
    return j.withColumns(
        {
            "x": F.when(horizontal, F.col("_iw") - F.col("x") - F.col("w")).otherwise(F.col("x")),
            "y": F.when(vertical, F.col("_ih") - F.col("y") - F.col("h")).otherwise(F.col("y")),
        }
    ).drop("_iw", "_ih")


def pad_labels(labels: DataFrame, max_labels: int = 50) -> DataFrame:
    """Fixed-length label matrix per image: [class, cx, cy, w, h] rows, cut or zero-padded to ``max_labels``.

    Only the first ``max_labels`` boxes (by ann_id) travel; Spark cuts to them
    before the shuffle.
    """
    from tessera.operators.nms import cap_per_image

    first = cap_per_image(labels, max_labels, [F.col("ann_id")])
    row = F.array(F.col("category_id").cast("double"), "cx", "cy", "nw", "nh")
    packed = first.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("ann_id", row.alias("row")))).alias("_rows"))
    zero = F.array(*[F.lit(0.0)] * 5)
    padded = F.slice(F.concat(F.transform("_rows", lambda r: r["row"]), F.array_repeat(zero, max_labels)), 1, max_labels)
    return packed.select("image_id", padded.alias("labels"))


def clip_corner_columns(x1, y1, x2, y2, width, height):
    return clip(x1, 0.0, width), clip(y1, 0.0, height), clip(x2, 0.0, width), clip(y2, 0.0, height)
