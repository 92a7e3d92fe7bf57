"""Registered queries: box and polygon geometry, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import boxes as bx
from tessera.functions import polygons as pg
from tessera.operators import nms, shapes, stats
from tessera.plans.tiling import OCTAGON
from tessera.sources import fixtures as fx


def convert_boxes(spark, sf):
    a = fx.annotations(spark, sf).withColumns({"x": F.col("x") + 0.75, "w": F.col("w") + 0.5})
    box = bx.corners()
    cx, cy, _, _ = bx.xywh_to_centre(*(F.col(c) for c in "xywh"))
    tx, ty, tw, th = bx.xyxy_to_xywh(box, truncate=True)
    back = bx.centre_to_xyxy(cx, cy, F.col("w"), F.col("h"))
    px, py, pw, ph = bx.points_to_xywh(bx.four_points(*(F.col(c) for c in "xywh")))
    return a.select(
        "ann_id", cx.alias("cx"), cy.alias("cy"), box.x2.alias("x2"), box.y2.alias("y2"),
        tx.alias("tx"), ty.alias("ty"), tw.alias("tw"), th.alias("th"),
        back.x1.alias("bx1"), back.y2.alias("by2"),
        px.alias("px"), py.alias("py"), pw.alias("pw"), ph.alias("ph"),
    )


def normalise_boxes(spark, sf):
    normal = shapes.normalise_boxes(fx.annotations(spark, sf), fx.images(spark, sf))
    pixel = shapes.denormalise_boxes(normal)
    return pixel.select(
        "ann_id",
        *["cx", "cy", "nw", "nh", "nx1", "ny1", "nx2", "ny2"],
        F.round("px", 4).alias("px"), F.round("py", 4).alias("py"), F.round("pw", 4).alias("pw"), F.round("ph", 4).alias("ph"),
    )


def clip_boxes(spark, sf):
    frames = fx.images(spark, sf)
    clamp = shapes.clip_boxes(fx.detections(spark, sf), frames, "clamp").select("det_id", F.lit("clamp").alias("policy"), "x", "y", "w", "h")
    shift = shapes.clip_boxes(fx.detections(spark, sf), frames, "shift").select("det_id", F.lit("shift").alias("policy"), "x", "y", "w", "h")
    return clamp.unionByName(shift)


def _polygons(spark, sf):
    """Octagon rings of the detections; those of boxes over the left or top edge have negative corners."""
    return fx.detections(spark, sf).withColumn("segmentation", F.expr(OCTAGON))


def filter_valid_shapes(spark, sf):
    kept = stats.filter_valid_shapes(_polygons(spark, sf), min_size=40.0)
    return kept.select("det_id", "x", "y", "w", "h")


def filter_confidence(spark, sf):
    """The cap comes before the threshold."""
    capped = nms.cap_per_image(fx.detections(spark, sf), 4, [F.col("det_id")])
    return nms.filter_confidence(capped, 0.5).select("image_id", "det_id", "score")


def filter_box_scale(spark, sf):
    return shapes.filter_box_scale(fx.annotations(spark, sf), 32.0, 96.0).select("ann_id", "w", "h")


def polygon_measures(spark, sf):
    ring = pg.to_points(F.col("segmentation")[0])
    x, y, w, h = pg.enclosing_box(ring)
    return _polygons(spark, sf).select(
        "det_id", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"),
        F.round(pg.shoelace_area(ring), 4).alias("area"), (w * h).alias("box_area"),
    )


def polygon_reshape(spark, sf):
    ring = pg.to_points(F.col("segmentation")[0])
    cut = pg.truncate_points(ring)
    swapped = pg.swap_axes(cut)
    scaled = pg.truncate_points(pg.scale_points(ring, F.lit(0.5), F.lit(2.0)))

    def text(points):
        return F.concat_ws(",", F.transform(pg.to_flat(points), lambda v: v.cast("string")))

    return _polygons(spark, sf).select(
        "det_id", F.size(ring).alias("n"), text(cut).alias("cut"), text(swapped).alias("swapped"), text(scaled).alias("scaled")
    )


def prune_coco(spark, sf):
    rich = fx.annotations(spark, sf).withColumn("iscrowd", (F.col("ann_id") % 5 == 0).cast("int")).withColumn("segmentation", F.expr(OCTAGON))
    return shapes.prune_coco(rich)


QUERIES = {
    "convert_boxes": convert_boxes,
    "normalise_boxes": normalise_boxes,
    "clip_boxes": clip_boxes,
    "filter_valid_shapes": filter_valid_shapes,
    "filter_confidence": filter_confidence,
    "filter_box_scale": filter_box_scale,
    "polygon_measures": polygon_measures,
    "polygon_reshape": polygon_reshape,
    "prune_coco": prune_coco,
}

_RING = "[x + w*0.25, y, x + w*0.75, y, x + w, y + h*0.25, x + w, y + h*0.75, x + w*0.75, y + h, x + w*0.25, y + h, x, y + h*0.75, x, y + h*0.25]"


def _joined(values: str) -> str:
    return f"array_to_string([CAST(CAST(trunc(v) AS INT) AS VARCHAR) FOR v IN {values}], ',')"


SQL = {
    "convert_boxes": fx.with_ctes(
        """WITH a AS (SELECT ann_id, x + 0.75 AS x, y, w + 0.5 AS w, h FROM annotations)
        SELECT ann_id, x + w/2 AS cx, y + h/2 AS cy, x + w AS x2, y + h AS y2,
               CAST(trunc(x) AS INT) AS tx, CAST(trunc(y) AS INT) AS ty,
               CAST(trunc(x + w) AS INT) - CAST(trunc(x) AS INT) AS tw, CAST(trunc(y + h) AS INT) - CAST(trunc(y) AS INT) AS th,
               x AS bx1, y + h AS by2,
               CAST(trunc(x) AS INT) AS px, CAST(trunc(y) AS INT) AS py, CAST(trunc(w) AS INT) AS pw, CAST(trunc(h) AS INT) AS ph
        FROM a""",
        "annotations",
    ),
    "normalise_boxes": fx.with_ctes(
        """SELECT ann_id, (2*x + w)/(2*width) AS cx, (2*y + h)/(2*height) AS cy, w/width AS nw, h/height AS nh,
               x/width AS nx1, y/height AS ny1, (x + w)/width AS nx2, (y + h)/height AS ny2,
               x AS px, y AS py, w AS pw, h AS ph
        FROM annotations JOIN images USING (image_id)""",
        "annotations",
        "images",
    ),
    "clip_boxes": fx.with_ctes(
        """WITH j AS (SELECT d.*, width, height FROM detections d JOIN images USING (image_id)),
        c AS (SELECT det_id, greatest(x, 0) AS x, greatest(y, 0) AS y,
                     least(width, greatest(x, 0) + greatest(w, 0)) AS x2, least(height, greatest(y, 0) + greatest(h, 0)) AS y2, w*h AS area FROM j),
        s AS (SELECT det_id, greatest(x, 0) AS x, greatest(y, 0) AS y, w - greatest(greatest(x, 0) + w - width, 0) AS w,
                     h - greatest(greatest(y, 0) + h - height, 0) AS h FROM j)
        SELECT det_id, 'clamp' AS policy, x, y, x2 - x AS w, y2 - y AS h FROM c WHERE area > 0 AND x2 >= x AND y2 >= y
        UNION ALL
        SELECT det_id, 'shift', x, y, w, h FROM s WHERE w > 0 AND h > 0""",
        "detections",
        "images",
    ),
    "filter_valid_shapes": fx.with_ctes(
        "SELECT det_id, x, y, w, h FROM detections WHERE w >= 40 AND h >= 40 AND x >= 0 AND y >= 0", "detections"
    ),
    "filter_confidence": fx.with_ctes(
        """SELECT image_id, det_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY det_id) AS nth FROM detections)
        WHERE nth <= 4 AND score >= 0.5""",
        "detections",
    ),
    "filter_box_scale": fx.with_ctes("SELECT ann_id, w, h FROM annotations WHERE w*h > 1024 AND w*h < 9216", "annotations"),
    "polygon_measures": fx.with_ctes(
        "SELECT det_id, x, y, w, h, round(w*h*0.875, 4) AS area, w*h AS box_area FROM detections", "detections"
    ),
    "polygon_reshape": fx.with_ctes(
        f"""WITH r AS (SELECT det_id, {_RING} AS ring FROM detections)
        SELECT det_id, 8 AS n, {_joined('ring')} AS cut,
               {_joined('[ring[CAST(CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END AS BIGINT)] FOR i IN range(1, 17)]')} AS swapped,
               {_joined('[ring[i] * CASE WHEN i % 2 = 1 THEN 0.5 ELSE 2.0 END FOR i IN range(1, 17)]')} AS scaled
        FROM r""",
        "detections",
    ),
    "prune_coco": fx.with_ctes(
        "SELECT ann_id, image_id, category_id, x, y, w, h FROM annotations WHERE ann_id % 5 <> 0", "annotations"
    ),
}
