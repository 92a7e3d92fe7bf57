"""Box geometry as Column expressions.  Boxes are stored as x, y, w, h doubles."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Corners(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column


def corners(prefix: str = "") -> Corners:
    x, y = F.col(f"{prefix}x"), F.col(f"{prefix}y")
    return Corners(x, y, x + F.col(f"{prefix}w"), y + F.col(f"{prefix}h"))


def xyxy_to_xywh(b: Corners, truncate: bool = False) -> tuple[Column, Column, Column, Column]:
    """Corners to top-left plus size; ``truncate`` first cuts every corner to an integer."""
    if truncate:
        b = Corners(*[c.cast("int") for c in b])
    return (b.x1, b.y1, b.x2 - b.x1, b.y2 - b.y1)


def xywh_to_centre(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    return (x + w * 0.5, y + h * 0.5, w, h)


def centre_to_xyxy(cx: Column, cy: Column, w: Column, h: Column) -> Corners:
    x1, y1 = cx - w * 0.5, cy - h * 0.5
    return Corners(x1, y1, x1 + w, y1 + h)


def four_points(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Clockwise from the top left: [[x, y], ...]."""
    return F.array(F.array(x, y), F.array(x + w, y), F.array(x + w, y + h), F.array(x, y + h))


def points_to_xywh(points: Column) -> tuple[Column, Column, Column, Column]:
    """Enclosing integer box of [[x, y], ...]; fractions of corners and sizes are dropped."""
    xs = F.transform(points, lambda p: p[0])
    ys = F.transform(points, lambda p: p[1])
    x, y = F.array_min(xs), F.array_min(ys)
    return (
        x.cast("int"),
        y.cast("int"),
        (F.array_max(xs) - x).cast("int"),
        (F.array_max(ys) - y).cast("int"),
    )


def clip(value: Column, low: Column | float, high: Column | float) -> Column:
    low = F.lit(low) if not isinstance(low, Column) else low
    high = F.lit(high) if not isinstance(high, Column) else high
    return F.least(F.greatest(value, low), high)


def intersection(a: Corners, b: Corners, pixel: float = 0.0) -> Column:
    iw = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1) + F.lit(pixel)
    ih = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1) + F.lit(pixel)
    return F.greatest(iw, F.lit(0.0)) * F.greatest(ih, F.lit(0.0))


def area(b: Corners, pixel: float = 0.0) -> Column:
    return (b.x2 - b.x1 + F.lit(pixel)) * (b.y2 - b.y1 + F.lit(pixel))


def iou(a: Corners, b: Corners, pixel: float = 0.0, eps: float = 0.0) -> Column:
    """Intersection over union; ``pixel`` = 1 counts both edge pixels, ``eps`` pads the denominator.

    Two empty boxes have no union: the result is 0.
    """
    inter = intersection(a, b, pixel)
    union = area(a, pixel) + area(b, pixel) - inter + F.lit(eps)
    return F.coalesce(F.try_divide(inter, union), F.lit(0.0))


def crowd_overlap(det: Corners, crowd: Corners) -> Column:
    """Overlap with a crowd region: share of the detection that lies inside."""
    return F.coalesce(F.try_divide(intersection(det, crowd), area(det)), F.lit(0.0))
