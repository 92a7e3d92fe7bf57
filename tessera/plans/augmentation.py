"""Registered queries: augmentation of annotations, raw head output, predictions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.seeded import unit_random
from tessera.functions import polygons as pg
from tessera.operators import augment, nms, predict, shapes
from tessera.plans.tiling import OCTAGON, with_octagons
from tessera.sources import fixtures as fx

RANGES = augment.AffineRange()


def _r(c, d=4):
    return F.round(c, d).alias(c)


def expand_augmentations(spark, sf):
    out = augment.expand_augmentations(fx.images(spark, sf), 3)
    return out.select("image_id", "copy_no", "copy_name", F.round(unit_random("angle", F.col("image_id"), F.col("copy_no")), 9).alias("draw"))


def affine_boxes(spark, sf):
    copies = augment.expand_augmentations(fx.images(spark, sf), 2)
    out = augment.affine_boxes(fx.annotations(spark, sf), augment.with_affine(copies, RANGES, "aff"), min_size=1.0)
    return out.select("ann_id", "copy_no", _r("x"), _r("y"), _r("w"), _r("h"))


def affine_polygons(spark, sf):
    frames = augment.with_affine(fx.images(spark, sf), RANGES, "aff")
    out = augment.affine_polygons(with_octagons(fx.annotations(spark, sf)), frames)
    return out.select("ann_id", F.size(F.col("segmentation")[0]).alias("numbers"), F.round("area", 3).alias("area"))


def clip_polygons_to_image(spark, sf):
    out = augment.clip_polygons_to_image(fx.detections(spark, sf).withColumn("segmentation", F.expr(OCTAGON)), fx.images(spark, sf))
    ring = pg.to_points(F.col("segmentation")[0])
    x, y, w, h = pg.enclosing_box(ring)
    return out.select("det_id", x.alias("bx"), y.alias("by"), (x + w).alias("bx2"), (y + h).alias("by2"))


def flip_boxes(spark, sf):
    coin = unit_random("flip", F.col("image_id")) < 0.5
    out = shapes.flip_boxes(fx.annotations(spark, sf), fx.images(spark, sf), coin, ~coin)
    return out.select("ann_id", "x", "y", "w", "h")


def letterbox_boxes(spark, sf):
    out = shapes.letterbox_boxes(fx.annotations(spark, sf), fx.images(spark, sf), 24, 40)
    return out.select("ann_id", _r("ratio", 8), "resized_h", "resized_w", _r("x", 6), _r("y", 6), _r("w", 6), _r("h", 6))


def letterbox_round_trip(spark, sf):
    out = shapes.unletterbox_boxes(shapes.letterbox_boxes(fx.annotations(spark, sf), fx.images(spark, sf), 640, 640))
    return out.select("ann_id", _r("x"), _r("y"), _r("w"), _r("h"))


def mosaic_annotations(spark, sf):
    out = augment.mosaic_annotations(fx.annotations(spark, sf), fx.images(spark, sf), 640, 640)
    return out.select("image_id", "slot", "source_id", "ann_id", _r("x"), _r("y"), _r("w"), _r("h"))


def mixup_annotations(spark, sf):
    out = augment.mixup_annotations(fx.annotations(spark, sf), fx.images(spark, sf), 640, 640)
    return out.select("image_id", "origin", "ann_id", _r("x"), _r("y"), _r("w"), _r("h"))


def pad_labels(spark, sf):
    normal = shapes.normalise_boxes(fx.annotations(spark, sf), fx.images(spark, sf))
    out = shapes.pad_labels(normal, 6)
    row = F.col("labels")
    return out.select(
        "image_id",
        F.size(row).alias("rows"),
        F.array_join(F.transform(row, lambda r: r[0].cast("int").cast("string")), ",").alias("classes"),
        row[0][1].alias("first_cx"),
        row[5][3].alias("last_w"),
    )


def _raw_head(spark, sf):
    """Head output of a 320 x 320 input (2,100 cells) derived from the detections."""
    d = fx.detections(spark, sf)
    return d.select(
        "det_id", "image_id", (F.col("det_id") % 2100).alias("cell"),
        (F.col("x") / 600).alias("tx"), (F.col("y") / 440).alias("ty"), (F.col("w") / 100 - 1).alias("tw"), (F.col("h") / 100 - 1).alias("th"),
        F.col("score").alias("objectness"),
        F.array(*[((F.col("det_id") * k) % 101 / 101.0).cast("double") for k in (3, 7, 11, 19, 31)]).alias("class_scores"),
    )


def decode_grid(spark, sf):
    out = nms.decode_grid(_raw_head(spark, sf), 320, 320)
    return out.select("det_id", _r("cx", 6), _r("cy", 6), _r("bw", 6), _r("bh", 6))


def score_candidates(spark, sf):
    return nms.score_candidates(_raw_head(spark, sf), 0.4).select("det_id", "class_idx", F.round("score", 9).alias("score"))


def score_candidates_per_class(spark, sf):
    return nms.score_candidates(_raw_head(spark, sf), 0.4, per_class=True).select("det_id", "class_idx", F.round("score", 9).alias("score"))


# ---------------------------------------------------------------- predictions


def _predictions(spark, sf):
    """Detections as model output: position by id, classes from 0, corners in [0, 1], octagon polygon."""
    d = fx.detections(spark, sf).join(fx.images(spark, sf).select("image_id", "width", "height"), "image_id")
    return d.select(
        "image_id", F.col("det_id").alias("pos"), (F.col("category_id") - 1).alias("class_idx"), "score",
        (F.col("x") / F.col("width")).alias("nx1"), (F.col("y") / F.col("height")).alias("ny1"),
        ((F.col("x") + F.col("w")) / F.col("width")).alias("nx2"), ((F.col("y") + F.col("h")) / F.col("height")).alias("ny2"),
        pg.to_points(F.expr(OCTAGON)[0]).alias("polygon"),
    )


def _labelmap(spark, sf):
    return fx.categories(spark, sf).select((F.col("category_id") - 1).alias("class_idx"), F.col("name").alias("label"))


def _preannotate(spark, sf, task):
    return predict.preannotate(_predictions(spark, sf), fx.images(spark, sf), fx.categories(spark, sf), _labelmap(spark, sf), task, 0.3)


def preannotate_detection(spark, sf):
    return _preannotate(spark, sf, "detection").select("ann_id", "image_id", "category_id", "x", "y", "w", "h", "area")


def preannotate_segmentation(spark, sf):
    out = _preannotate(spark, sf, "segmentation")
    return out.select("ann_id", "image_id", "category_id", "x", "y", "w", "h", F.round("area", 1).alias("area"), F.size(F.col("segmentation")[0]).alias("numbers"))


def preannotate_classification(spark, sf):
    return _preannotate(spark, sf, "classification").select("ann_id", "image_id", "category_id", "w", "h", "area", "is_classification")


def format_predictions(spark, sf):
    out = None
    for task in ("detection", "classification"):
        rows = predict.format_predictions(_predictions(spark, sf), fx.images(spark, sf), _labelmap(spark, sf), task, 0.5)
        rows = rows.select("image_id", "shape", "x", "y", "w", "h", "label", "score")
        out = rows if out is None else out.unionByName(rows)
    return out


def format_array_predictions(spark, sf):
    """Detector output as arrays per image, y first, classes from 1."""
    p = _predictions(spark, sf)
    arrays = p.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.array("ny1", "nx1", "ny2", "nx2").alias("b"), "score", "class_idx"))).alias("r"))
    packed = arrays.select(
        "image_id", F.col("r.b").alias("detection_boxes"), F.col("r.score").alias("detection_scores"),
        F.transform("r.class_idx", lambda c: (c + 1).cast("double")).alias("detection_classes"),
    )
    flat = predict.explode_array_predictions(packed)
    out = predict.format_predictions(flat, fx.images(spark, sf), _labelmap(spark, sf), "detection", 0.5, shift=1, limit=10)
    return out.select("image_id", "pos", "x", "y", "w", "h", "label")


def flatten_ocr_results(spark, sf):
    d = fx.detections(spark, sf).withColumns({"x": F.col("x") + 0.6, "w": F.col("w") + 0.7})
    points = F.array(F.array("x", "y"), F.array(F.col("x") + F.col("w"), F.col("y")), F.array(F.col("x") + F.col("w"), F.col("y") + F.col("h")), F.array(F.col("x"), F.col("y") + F.col("h")))
    line = F.struct("det_id", points.alias("points"), F.concat(F.lit("t"), F.col("category_id")).alias("text"), F.col("score").alias("confidence"))
    results = d.groupBy("image_id").agg(F.array_sort(F.collect_list(line)).alias("result"))
    out = predict.flatten_ocr_results(fx.images(spark, sf).join(results, "image_id", "left"))
    return out.select("image_id", "pos", "x", "y", "w", "h", "text", "confidence")


def _box_model():
    """A stand-in model: one box per letter class of the text, failing on empty input."""

    def run(inputs):
        out = []
        for text in inputs:
            if not text:
                raise ValueError("empty input")
            n = len(text)
            out.append([(i, i, ((n * (i + 3)) % 100) / 100, 0.1 * i, 0.1, 0.1 * i + 0.2, 0.5, None) for i in range(1 + n % 3)])
        return out

    return run


def batch_predict(spark, sf):
    """The model runs over the whole texts of the documents; every 50th input is empty and fails."""
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("image_id"), F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.col("text")).alias("content"))
    out = predict.batch_predict(docs, _box_model, batch_size=32)
    return out.select("image_id", "pos", "class_idx", F.round("score", 6).alias("score"), "error")


def embed(spark, sf):
    """Random projection of the stored vectors to 8 numbers of unit length."""
    v = fx.table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = predict.embed(v.select("vec_id", F.col("embedding").alias("pixels")), predict.linear_embedder(8), "pixels", 8, tensor_shape=[64])
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return out.select("vec_id", F.size("embedding").alias("size"), F.round(norm, 4).alias("norm"))


_QUERY_NAMES = (
    "expand_augmentations affine_boxes affine_polygons clip_polygons_to_image flip_boxes letterbox_boxes letterbox_round_trip mosaic_annotations "
    "mixup_annotations pad_labels decode_grid score_candidates score_candidates_per_class preannotate_detection preannotate_segmentation "
    "preannotate_classification format_predictions format_array_predictions flatten_ocr_results batch_predict embed"
).split()
QUERIES = {n: globals()[n] for n in _QUERY_NAMES}


def _u(seed: str, *parts: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *parts])
    return f"(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE)"


def _uni(seed: str, lo: str, hi: str, *parts: str) -> str:
    return f"({lo} + ({hi} - {lo}) * {_u(seed, *parts)})"


_KEY = ("image_id", "copy_no")
_MATRIX = f"""
draws AS (SELECT *, radians({_uni('aff:angle', '-10.0::DOUBLE', '10.0::DOUBLE', *_KEY)}) AS ang, {_uni('aff:scale', '0.9::DOUBLE', '1.1::DOUBLE', *_KEY)} AS sc,
  tan(radians({_uni('aff:shear_x', '-10.0::DOUBLE', '10.0::DOUBLE', *_KEY)})) AS shx, tan(radians({_uni('aff:shear_y', '-10.0::DOUBLE', '10.0::DOUBLE', *_KEY)})) AS shy,
  {_uni('aff:translate_x', '-0.1::DOUBLE', '0.1::DOUBLE', *_KEY)} * width AS tx, {_uni('aff:translate_y', '-0.1::DOUBLE', '0.1::DOUBLE', *_KEY)} * height AS ty
  FROM images CROSS JOIN (SELECT unnest([0, 1]) AS copy_no)),
m AS (SELECT *, sc*cos(ang) AS a, sc*sin(ang) AS b FROM draws)"""


def _corner(px: str, py: str) -> tuple[str, str]:
    return (f"((a - shy*b)*({px}) + (b + shy*a)*({py}) + tx)", f"((shx*a - b)*({px}) + (shx*b + a)*({py}) + ty)")


_CS = [_corner("x", "y"), _corner("x + w", "y + h"), _corner("x", "y + h"), _corner("x + w", "y")]
_XS, _YS = ", ".join(c[0] for c in _CS), ", ".join(c[1] for c in _CS)

_RESIZED = "rs AS (SELECT image_id AS source_id, least(640.0::DOUBLE/height, 640.0::DOUBLE/width) AS scale, CAST(trunc(width*least(640.0::DOUBLE/height, 640.0::DOUBLE/width)) AS INT) AS rw, CAST(trunc(height*least(640.0::DOUBLE/height, 640.0::DOUBLE/width)) AS INT) AS rh FROM images)"


def _clip(e: str, hi: str) -> str:
    return f"least(greatest({e}, 0), {hi})"


_CHOSEN = """p AS (SELECT d.*, width, height, row_number() OVER (PARTITION BY image_id ORDER BY det_id) AS nth FROM detections d JOIN images USING (image_id)),
chosen AS (SELECT * FROM p WHERE nth <= 100 AND score >= THRESHOLD)"""
_INT_BOX = """CAST(trunc(x/width*width) AS INT) AS x, CAST(trunc(y/height*height) AS INT) AS y,
  CAST(trunc(((x + w)/width - x/width)*width) AS INT) AS w, CAST(trunc(((y + h)/height - y/height)*height) AS INT) AS h"""
_BEST = """best AS (SELECT * FROM (SELECT d.*, width, height, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, category_id) AS nth FROM detections d JOIN images USING (image_id)) WHERE nth = 1)"""
_TRUNC_RING = "list_transform([x + w*0.25, y, x + w*0.75, y, x + w, y + h*0.25, x + w, y + h*0.75, x + w*0.75, y + h, x + w*0.25, y + h, x, y + h*0.75, x, y + h*0.25], lambda v: CAST(trunc(v) AS INT))"

SQL = {
    "expand_augmentations": fx.with_ctes(
        f"""SELECT image_id, copy_no, 'img_' || image_id || '_' || copy_no || '.jpg' AS copy_name, round({_u('angle', 'image_id', 'copy_no')}, 9) AS draw
        FROM images CROSS JOIN (SELECT unnest([0, 1, 2]) AS copy_no)""",
        "images",
    ),
    "affine_boxes": fx.with_ctes(
        f"""WITH {_MATRIX}, b AS (SELECT ann_id, copy_no, {_clip(f'least({_XS})', 'width')} AS x1, {_clip(f'least({_YS})', 'height')} AS y1,
          {_clip(f'greatest({_XS})', 'width')} AS x2, {_clip(f'greatest({_YS})', 'height')} AS y2 FROM annotations JOIN m USING (image_id))
        SELECT ann_id, copy_no, round(x1, 4) AS x, round(y1, 4) AS y, round(x2 - x1, 4) AS w, round(y2 - y1, 4) AS h FROM b WHERE x2 - x1 >= 1 AND y2 - y1 >= 1""",
        "images", "annotations",
    ),
    "flip_boxes": fx.with_ctes(
        f"""SELECT ann_id, CASE WHEN {_u('flip', 'image_id')} < 0.5 THEN width - x - w ELSE x END AS x, CASE WHEN {_u('flip', 'image_id')} < 0.5 THEN y ELSE height - y - h END AS y, w, h
        FROM annotations JOIN images USING (image_id)""",
        "images", "annotations",
    ),
    "letterbox_boxes": fx.with_ctes(
        """WITH r AS (SELECT image_id, least(24.0::DOUBLE/height, 40.0::DOUBLE/width) AS ratio, height, width FROM images),
        s AS (SELECT ann_id, ratio, CAST(trunc(height*ratio) AS INT) AS resized_h, CAST(trunc(width*ratio) AS INT) AS resized_w, x*ratio AS x, y*ratio AS y, w*ratio AS w, h*ratio AS h,
          bool_or(least(w*ratio, h*ratio) > 1) OVER (PARTITION BY image_id) AS any_left FROM annotations JOIN r USING (image_id))
        SELECT ann_id, round(ratio, 8) AS ratio, resized_h, resized_w, round(x, 6) AS x, round(y, 6) AS y, round(w, 6) AS w, round(h, 6) AS h FROM s WHERE least(w, h) > 1 OR NOT any_left""",
        "images", "annotations",
    ),
    "letterbox_round_trip": fx.with_ctes("SELECT ann_id, x, y, w, h FROM annotations", "annotations"),
    "mosaic_annotations": fx.with_ctes(
        f"""WITH {_RESIZED}, pool AS (SELECT image_id AS source_id, row_number() OVER (ORDER BY image_id) - 1 AS i FROM images),
        slots AS (SELECT image_id, slot, CAST(floor({_u('mosaic:partner', 'image_id', 'slot')} * (SELECT count(*) FROM images)) AS BIGINT) AS i FROM images CROSS JOIN (SELECT unnest([1, 2, 3]) AS slot)),
        placed AS (SELECT image_id, 0 AS slot, image_id AS source_id FROM images UNION ALL SELECT image_id, slot, source_id FROM slots JOIN pool USING (i)),
        centre AS (SELECT image_id, CAST(trunc({_uni('mosaic:yc', '320.0::DOUBLE', '960.0::DOUBLE', 'image_id')}) AS INT) AS yc, CAST(trunc({_uni('mosaic:xc', '320.0::DOUBLE', '960.0::DOUBLE', 'image_id')}) AS INT) AS xc FROM images),
        l AS (SELECT image_id, slot, source_id, scale, CASE WHEN slot IN (0, 2) THEN xc - rw ELSE xc END AS dx, CASE WHEN slot IN (0, 1) THEN yc - rh ELSE yc END AS dy
          FROM placed JOIN rs USING (source_id) JOIN centre USING (image_id)),
        b AS (SELECT l.image_id, slot, source_id, ann_id, {_clip('scale*x + dx', '1280')} AS x1, {_clip('scale*y + dy', '1280')} AS y1, {_clip('scale*(x + w) + dx', '1280')} AS x2, {_clip('scale*(y + h) + dy', '1280')} AS y2
          FROM l JOIN annotations a ON a.image_id = l.source_id)
        SELECT image_id, slot, source_id, ann_id, round(x1, 4) AS x, round(y1, 4) AS y, round(x2 - x1, 4) AS w, round(y2 - y1, 4) AS h FROM b""",
        "images", "annotations",
    ),
    "mixup_annotations": fx.with_ctes(
        f"""WITH {_RESIZED}, labelled AS (SELECT image_id FROM images WHERE image_id IN (SELECT image_id FROM annotations)),
        pool AS (SELECT image_id AS source_id, row_number() OVER (ORDER BY image_id) - 1 AS i FROM labelled),
        d AS (SELECT image_id, CAST(floor({_u('mixup:partner', 'image_id', '1')} * (SELECT count(*) FROM labelled)) AS BIGINT) AS i, {_uni('mixup:jitter', '0.5::DOUBLE', '1.5::DOUBLE', 'image_id')} AS jit,
          {_u('mixup:flip', 'image_id')} > 0.5 AS flip FROM images),
        o AS (SELECT *, CAST(trunc(jit*640) AS INT) AS ow, CAST(trunc(jit*640) AS INT) AS oh FROM d JOIN pool USING (i) JOIN rs USING (source_id)),
        f AS (SELECT *, CASE WHEN ow > 640 THEN floor({_u('mixup:x', 'image_id')} * (ow - 640)) ELSE 0 END AS ox, CASE WHEN oh > 640 THEN floor({_u('mixup:y', 'image_id')} * (oh - 640)) ELSE 0 END AS oy FROM o),
        s AS (SELECT f.image_id, ann_id, flip, ow, ox, oy, {_clip('x*scale*jit', 'ow')} AS a1, {_clip('(x + w)*scale*jit', 'ow')} AS a2, {_clip('y*scale*jit', 'oh')} AS b1, {_clip('(y + h)*scale*jit', 'oh')} AS b2
          FROM f JOIN annotations a ON a.image_id = f.source_id),
        t AS (SELECT image_id, ann_id, {_clip('CASE WHEN flip THEN ow - a2 ELSE a1 END - ox', '640')} AS x1, {_clip('CASE WHEN flip THEN ow - a1 ELSE a2 END - ox', '640')} AS x2, {_clip('b1 - oy', '640')} AS y1, {_clip('b2 - oy', '640')} AS y2 FROM s)
        SELECT image_id, 'own' AS origin, ann_id, x, y, w, h FROM annotations
        UNION ALL SELECT image_id, 'partner', ann_id, round(x1, 4), round(y1, 4), round(x2 - x1, 4), round(y2 - y1, 4) FROM t""",
        "images", "annotations",
    ),
    "pad_labels": fx.with_ctes(
        """WITH f AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) AS nth FROM annotations JOIN images USING (image_id)),
        g AS (SELECT image_id, list(category_id ORDER BY ann_id) AS c, min((2*x + w)/(2*width)) FILTER (WHERE nth = 1) AS first_cx, coalesce(min(w/width) FILTER (WHERE nth = 6), 0) AS last_w
              FROM f WHERE nth <= 6 GROUP BY 1)
        SELECT image_id, 6 AS rows, array_to_string(list_resize(c, 6, 0), ',') AS classes, first_cx, last_w FROM g""",
        "images", "annotations",
    ),
    "decode_grid": fx.with_ctes(
        """WITH r AS (SELECT det_id, det_id % 2100 AS cell, x/600 AS tx, y/440 AS ty, w/100 - 1 AS tw, h/100 - 1 AS th FROM detections),
        g AS (SELECT *, CASE WHEN cell < 1600 THEN 8 WHEN cell < 2000 THEN 16 ELSE 32 END AS s, CASE WHEN cell < 1600 THEN cell WHEN cell < 2000 THEN cell - 1600 ELSE cell - 2000 END AS k FROM r)
        SELECT det_id, round((tx + k % (320 // s))*s, 6) AS cx, round((ty + k // (320 // s))*s, 6) AS cy, round(exp(tw)*s, 6) AS bw, round(exp(th)*s, 6) AS bh FROM g""",
        "detections",
    ),
    "score_candidates": fx.with_ctes(
        """WITH c AS (SELECT det_id, score AS o, unnest([0, 1, 2, 3, 4]) AS k, unnest([CAST((det_id*3) % 101 AS DOUBLE)/101, CAST((det_id*7) % 101 AS DOUBLE)/101, CAST((det_id*11) % 101 AS DOUBLE)/101,
          CAST((det_id*19) % 101 AS DOUBLE)/101, CAST((det_id*31) % 101 AS DOUBLE)/101]) AS s FROM detections),
        r AS (SELECT *, row_number() OVER (PARTITION BY det_id ORDER BY s DESC, k) AS nth FROM c)
        SELECT det_id, k AS class_idx, round(o*s, 9) AS score FROM r WHERE nth = 1 AND o*s >= 0.4""",
        "detections",
    ),
    "score_candidates_per_class": fx.with_ctes(
        """WITH c AS (SELECT det_id, score AS o, unnest([0, 1, 2, 3, 4]) AS k, unnest([CAST((det_id*3) % 101 AS DOUBLE)/101, CAST((det_id*7) % 101 AS DOUBLE)/101, CAST((det_id*11) % 101 AS DOUBLE)/101,
          CAST((det_id*19) % 101 AS DOUBLE)/101, CAST((det_id*31) % 101 AS DOUBLE)/101]) AS s FROM detections)
        SELECT det_id, k AS class_idx, round(o*s, 9) AS score FROM c WHERE o*s > 0.4""",
        "detections",
    ),
    "preannotate_detection": fx.with_ctes(
        f"""WITH {_CHOSEN.replace('THRESHOLD', '0.3')}, b AS (SELECT det_id, image_id, category_id, {_INT_BOX} FROM chosen)
        SELECT row_number() OVER (ORDER BY image_id, det_id) AS ann_id, image_id, category_id, x, y, w, h, CAST(w*h AS DOUBLE) AS area FROM b""",
        "images", "detections",
    ),
    "preannotate_segmentation": fx.with_ctes(
        f"""WITH {_CHOSEN.replace('THRESHOLD', '0.3')}, b AS (SELECT det_id, image_id, category_id, {_TRUNC_RING} AS g FROM chosen),
        s AS (SELECT *, [g[2*i - 1] FOR i IN range(1, 9)] AS xs, [g[2*i] FOR i IN range(1, 9)] AS ys FROM b)
        SELECT row_number() OVER (ORDER BY image_id, det_id) AS ann_id, image_id, category_id, list_min(xs) AS x, list_min(ys) AS y, list_max(xs) - list_min(xs) AS w, list_max(ys) - list_min(ys) AS h,
          abs(list_sum([xs[i]*ys[i % 8 + 1] - xs[i % 8 + 1]*ys[i] FOR i IN range(1, 9)])) / 2.0::DOUBLE AS area, 16 AS numbers FROM s""",
        "images", "detections",
    ),
    "preannotate_classification": fx.with_ctes(
        f"""WITH {_BEST} SELECT row_number() OVER (ORDER BY image_id) AS ann_id, image_id, category_id, width AS w, height AS h, CAST(width AS DOUBLE)*height AS area, true AS is_classification
        FROM best WHERE score >= 0.3""",
        "images", "detections",
    ),
    "format_predictions": fx.with_ctes(
        f"""WITH {_CHOSEN.replace('THRESHOLD', '0.5')}, {_BEST}
        SELECT image_id, 'rectangles' AS shape, {_INT_BOX}, name AS label, score FROM chosen JOIN categories USING (category_id)
        UNION ALL SELECT image_id, 'classifications', NULL, NULL, NULL, NULL, name, score FROM best JOIN categories USING (category_id) WHERE score >= 0.5""",
        "images", "detections", "categories",
    ),
    "format_array_predictions": fx.with_ctes(
        f"""WITH {_CHOSEN.replace('THRESHOLD', '0.5')} SELECT image_id, CAST(nth - 1 AS INT) AS pos, {_INT_BOX}, name AS label FROM chosen JOIN categories USING (category_id) WHERE nth <= 10""",
        "images", "detections", "categories",
    ),
    "flatten_ocr_results": fx.with_ctes(
        """WITH d AS (SELECT det_id, image_id, category_id, score, x + 0.6 AS x, y, w + 0.7 AS w, h FROM detections)
        SELECT image_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS INT) AS pos, CAST(trunc(x) AS INT) AS x, CAST(trunc(y) AS INT) AS y,
        CAST(trunc((x + w) - x) AS INT) AS w, CAST(trunc((y + h) - y) AS INT) AS h, 't' || category_id AS text, score AS confidence FROM d""",
        "detections",
    ),
}
SQL["batch_predict"] = """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 0 ELSE length(text) END AS n FROM documents),
p AS (SELECT doc_id, n, unnest(range(CAST(1 + n % 3 AS BIGINT))) AS i FROM d WHERE n > 0)
SELECT doc_id AS image_id, CAST(i AS INT) AS pos, CAST(i AS INT) AS class_idx, round(CAST((n*(i + 3)) % 100 AS DOUBLE)/100, 6) AS score, CAST(NULL AS VARCHAR) AS error FROM p
UNION ALL SELECT doc_id, NULL, NULL, NULL, 'empty input' FROM d WHERE n = 0"""
SQL["embed"] = "SELECT vec_id, 8 AS size, 1.0::DOUBLE AS norm FROM embeddings"
