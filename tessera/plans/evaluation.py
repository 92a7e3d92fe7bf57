"""Registered queries: detection metrics and suppression."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate, nms, overlap
from tessera.sources import fixtures as fx


def _truths(spark, sf):
    """Annotations with the evaluator's columns; every seventh id is difficult, every thirteenth a crowd."""
    return fx.annotations(spark, sf).withColumn("difficult", F.col("ann_id") % 7 == 0)


def _truths_with_crowds(spark, sf):
    return fx.annotations(spark, sf).withColumn("iscrowd", (F.col("ann_id") % 13 == 0).cast("int"))


def iou_join(spark, sf):
    pairs = overlap.iou_join(fx.detections(spark, sf), fx.annotations(spark, sf))
    return pairs.select("image_id", F.col("a_det_id").alias("det_id"), F.col("b_ann_id").alias("ann_id"), F.round("iou", 6).alias("iou"))


def iou_join_pixel(spark, sf):
    """Inclusive pixel edges, same class, padded denominator; best per image."""
    pairs = overlap.iou_join(fx.detections(spark, sf), fx.annotations(spark, sf), ["image_id", "category_id"], pixel=1.0, eps=1e-12)
    return pairs.groupBy("image_id").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.max("iou"), 11).alias("iou_max"))


def _boxes_as_runs(df, id_col):
    """Rows of a box mask as runs, all equal and so one band; end exclusive."""
    return df.select(
        "image_id",
        F.col(id_col).alias("mask_id"),
        F.col("y").cast("int").alias("row"),
        F.col("h").cast("int").alias("rows"),
        F.col("x").cast("int").alias("start"),
        (F.col("x") + F.col("w")).cast("int").alias("end"),
    )


def mask_iou_join(spark, sf):
    dets = _boxes_as_runs(fx.detections(spark, sf), "det_id")
    truths = _boxes_as_runs(fx.annotations(spark, sf), "ann_id")
    return overlap.mask_iou_join(dets, truths).select("image_id", "a_mask", "b_mask", F.round("iou", 6).alias("iou"))


def mutual_best_match(spark, sf):
    out = evaluate.mutual_best_match(fx.detections(spark, sf), fx.annotations(spark, sf), 0.5)
    return out.select("image_id", "ann_id", "det_id", F.round("iou", 6).alias("iou"), "true_category", "pred_category")


def voc_match(spark, sf):
    return evaluate.voc_match(fx.detections(spark, sf), _truths(spark, sf)).select("det_id", "ann_id", "outcome")


def _curve(spark, sf):
    truths = _truths(spark, sf)
    positives = evaluate.voc_positives(truths)
    return evaluate.pr_curve(evaluate.voc_match(fx.detections(spark, sf), truths), positives), positives


def pr_curve(spark, sf):
    curve, _ = _curve(spark, sf)
    return curve.select("category_id", "det_id", "tp", "fp", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


def average_precision(spark, sf):
    curve, positives = _curve(spark, sf)
    out = None
    for method in ("area", "voc07", "coco"):
        ap = evaluate.average_precision(curve, positives, method).select(F.lit(method).alias("method"), "category_id", F.round("ap", 6).alias("ap"))
        out = ap if out is None else out.unionByName(ap)
    return out


def voc_summary(spark, sf):
    out = evaluate.voc_summary(fx.detections(spark, sf), _truths(spark, sf))
    return out.select(F.round("map", 6).alias("map"), F.round("map50", 6).alias("map50"))


ONE_THRESHOLD = evaluate.CocoGrid(thresholds=(0.5,), areas={"all": (0.0, 1e10), "medium": (32.0**2, 96.0**2)})


def coco_match(spark, sf):
    out = evaluate.coco_match(fx.detections(spark, sf), _truths_with_crowds(spark, sf), ONE_THRESHOLD)
    return out.select("area_range", "det_id", "ann_id", "ann_ignored")


def _metrics(spark, sf):
    return evaluate.coco_class_metrics(fx.detections(spark, sf), _truths_with_crowds(spark, sf))


def detection_summary(spark, sf):
    return evaluate.coco_summary(_metrics(spark, sf)).select("metric", F.round("value", 6).alias("value"))


def per_class_table(spark, sf):
    out = evaluate.per_class_table(_metrics(spark, sf), fx.categories(spark, sf))
    return out.select("name", F.round("ap", 5).alias("ap"), F.round("ar", 5).alias("ar"))


def _cases(spark, sf, strict=False):
    return evaluate.confusion_cases(fx.detections(spark, sf), fx.annotations(spark, sf), 0.5, 0.25, strict)


def detection_confusion(spark, sf):
    return evaluate.detection_confusion(_cases(spark, sf))


def detection_confusion_strict(spark, sf):
    return evaluate.detection_confusion(_cases(spark, sf, strict=True)).select("true_category", "pred_category", "n")


def confusion_files(spark, sf):
    return evaluate.confusion_files(_cases(spark, sf), fx.images(spark, sf))


def per_image_confusion(spark, sf):
    return evaluate.per_image_confusion(_cases(spark, sf))


def nms_per_class(spark, sf):
    return nms.nms_per_class(fx.detections(spark, sf), 0.1, min_score=0.1).select("image_id", "category_id", "det_id", "score")


def nms_per_class_rounds(spark, sf):
    """The same result by the whole-table rounds that large groups take."""
    return nms.nms_per_class(fx.detections(spark, sf), 0.1, min_score=0.1, array_rows=1).select("image_id", "category_id", "det_id", "score")


def nms_agnostic(spark, sf):
    return nms.nms_agnostic(fx.detections(spark, sf), 0.05, min_score=0.2).select("image_id", "det_id", "score")


QUERIES = {
    "iou_join": iou_join,
    "iou_join_pixel": iou_join_pixel,
    "mask_iou_join": mask_iou_join,
    "mutual_best_match": mutual_best_match,
    "voc_match": voc_match,
    "pr_curve": pr_curve,
    "average_precision": average_precision,
    "voc_summary": voc_summary,
    "coco_match": coco_match,
    "detection_summary": detection_summary,
    "per_class_table": per_class_table,
    "detection_confusion": detection_confusion,
    "detection_confusion_strict": detection_confusion_strict,
    "confusion_files": confusion_files,
    "per_image_confusion": per_image_confusion,
    "nms_per_class": nms_per_class,
    "nms_per_class_rounds": nms_per_class_rounds,
    "nms_agnostic": nms_agnostic,
}


def _iou(a: str, b: str, px: str = "0") -> str:
    inter = (
        f"greatest(0, least({a}.x+{a}.w, {b}.x+{b}.w) - greatest({a}.x, {b}.x) + {px})"
        f" * greatest(0, least({a}.y+{a}.h, {b}.y+{b}.h) - greatest({a}.y, {b}.y) + {px})"
    )
    area_a, area_b = f"(({a}.w+{px})*({a}.h+{px}))", f"(({b}.w+{px})*({b}.h+{px}))"
    return f"(({inter}) / ({area_a} + {area_b} - ({inter})))"


_VOC = f"""
truths AS (SELECT *, ann_id % 7 = 0 AS difficult FROM annotations),
best AS (
  SELECT d.det_id, d.category_id, d.score, t.ann_id, t.difficult, {_iou('d', 't', '1')} AS iou,
         row_number() OVER (PARTITION BY d.det_id ORDER BY {_iou('d', 't', '1')} DESC, t.ann_id) AS nth
  FROM detections d JOIN truths t ON d.image_id = t.image_id AND d.category_id = t.category_id),
claims AS (
  SELECT d.det_id, d.category_id, d.score, b.ann_id, b.difficult
  FROM detections d LEFT JOIN best b ON d.det_id = b.det_id AND b.nth = 1 AND b.iou > THRESHOLD),
outcomes AS (
  SELECT *, CASE WHEN ann_id IS NULL THEN 'fp' WHEN difficult THEN 'ignored'
                 WHEN row_number() OVER (PARTITION BY ann_id ORDER BY score DESC, det_id) = 1 THEN 'tp' ELSE 'fp' END AS outcome
  FROM claims)"""

_CURVE = """
npos AS (SELECT category_id, count(*) FILTER (WHERE NOT difficult) AS npos FROM truths GROUP BY 1),
curve AS (
  SELECT o.*, npos, sum(CAST(outcome = 'tp' AS INT)) OVER w AS tp, sum(CAST(outcome = 'fp' AS INT)) OVER w AS fp
  FROM outcomes o JOIN npos USING (category_id)
  WINDOW w AS (PARTITION BY category_id ORDER BY score DESC, det_id ROWS UNBOUNDED PRECEDING)),
points AS (
  SELECT category_id, det_id, score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, outcome, npos,
         tp / npos AS recall, tp / greatest(tp + fp, 2.220446049250313e-16) AS precision
  FROM curve)"""


def _voc(tail: str, threshold: str = "0.5") -> str:
    return fx.with_ctes(f"WITH {_VOC.replace('THRESHOLD', threshold)}{tail}", "annotations", "detections")


_AREA = """
env AS (
  SELECT *, max(precision) OVER (PARTITION BY category_id ORDER BY score DESC, det_id
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS envelope,
         recall - lag(recall, 1, 0.0) OVER (PARTITION BY category_id ORDER BY score DESC, det_id) AS step
  FROM points),
area AS (SELECT category_id, sum(step * envelope) AS ap FROM env GROUP BY 1)"""

_MUTUAL = f"""
sure AS (SELECT * FROM detections WHERE score >= MINSCORE),
pairs AS (
  SELECT d.image_id, d.det_id, a.ann_id, d.category_id AS pred_category, a.category_id AS true_category, {_iou('d', 'a')} AS iou
  FROM sure d JOIN annotations a ON d.image_id = a.image_id WHERE {_iou('d', 'a')} > 0.5),
of_det AS (SELECT *, row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, ann_id) AS nth FROM pairs),
mutual AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ann_id ORDER BY iou DESC, det_id) AS nth2 FROM of_det WHERE nth = 1)
  WHERE nth2 = 1)"""

_CASES = """
cases AS (
  SELECT a.image_id, a.category_id AS true_category, coalesce(m.pred_category, 0) AS pred_category
  FROM annotations a LEFT JOIN mutual m USING (ann_id)
  UNION ALL
  SELECT s.image_id, 0, s.category_id FROM sure s WHERE s.det_id NOT IN (SELECT det_id FROM mutual) STRICT)"""


def _confusion(tail: str, strict: bool = False) -> str:
    cases = _CASES.replace("STRICT", "AND s.image_id IN (SELECT image_id FROM mutual)" if strict else "")
    return fx.with_ctes(f"WITH {_MUTUAL.replace('MINSCORE', '0.25')}, {cases} {tail}", "annotations", "detections", "images")


def _nms(keys: str, threshold: str, px: str, score: str) -> str:
    """Greedy pass by recursion over the rank inside each group; each row lists its earlier clashing ranks."""
    return fx.with_ctes(
        f"""WITH
        ranked AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, det_id) AS rk FROM detections WHERE score {score}),
        clash AS MATERIALIZED (
          SELECT b.det_id, list(a.rk) AS earlier FROM ranked a JOIN ranked b USING ({keys})
          WHERE a.rk < b.rk AND {_iou('a', 'b', px)} > {threshold} GROUP BY 1),
        todo AS MATERIALIZED (SELECT r.*, coalesce(c.earlier, []) AS earlier FROM ranked r LEFT JOIN clash c USING (det_id)),
        pass AS (
          SELECT {keys}, rk, det_id, score, [rk] AS kept, true AS keep FROM todo WHERE rk = 1
          UNION ALL
          SELECT {', '.join('t.' + k.strip() for k in keys.split(','))}, t.rk, t.det_id, t.score,
                 CASE WHEN list_has_any(t.earlier, p.kept) THEN p.kept ELSE list_append(p.kept, t.rk) END,
                 NOT list_has_any(t.earlier, p.kept)
          FROM pass p JOIN todo t ON t.rk = p.rk + 1 AND {' AND '.join(f't.{k.strip()} = p.{k.strip()}' for k in keys.split(','))})
        SELECT {keys}, det_id, score FROM pass WHERE keep""",
        "detections",
        recursive=True,
    )


_CROWD_IOU = f"""CASE WHEN t.iscrowd = 1 THEN
  (greatest(0, least(d.x+d.w, t.x+t.w) - greatest(d.x, t.x)) * greatest(0, least(d.y+d.h, t.y+t.h) - greatest(d.y, t.y))) / (d.w*d.h)
  ELSE {_iou('d', 't')} END"""

# Serial choice by recursion over the detection rank; every detection lists its options, best first.
_COCO_PASS = """
truths AS MATERIALIZED (SELECT *, CAST(ann_id % 13 = 0 AS INT) AS crowd FROM (TRUTHS)),
t AS MATERIALIZED (SELECT * REPLACE (crowd AS iscrowd) FROM truths),
capped AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, category_id ORDER BY score DESC, det_id) AS rk FROM (DETS))
  WHERE rk <= 100),
configs(iou_threshold, area_range, low, high) AS (CONFIGS),
pairs AS MATERIALIZED (
  SELECT d.det_id, t.ann_id, t.iscrowd, t.AREA AS ann_area, PAIRIOU AS iou
  FROM capped d JOIN t USING (image_id, category_id) WHERE PAIRIOU >= 0.5),
options AS MATERIALIZED (
  SELECT iou_threshold, area_range, det_id,
         list({'ann': ann_id, 'crowd': iscrowd = 1, 'ign': iscrowd = 1 OR ann_area < low OR ann_area > high}
              ORDER BY (iscrowd = 1 OR ann_area < low OR ann_area > high), iou DESC, ann_id DESC) AS opts
  FROM pairs JOIN configs ON iou >= least(iou_threshold, 1 - 1e-10) GROUP BY ALL),
todo AS MATERIALIZED (
  SELECT c.iou_threshold, c.area_range, d.image_id, d.category_id, d.det_id, d.score, d.rk, d.AREA AS det_area, c.low, c.high,
         coalesce(o.opts, []) AS opts
  FROM capped d CROSS JOIN configs c LEFT JOIN options o USING (iou_threshold, area_range, det_id)),
pass AS (
  SELECT iou_threshold, area_range, image_id, category_id, rk, det_id, score, det_area, low, high, opts[1] AS pick,
         CASE WHEN opts[1] IS NULL OR opts[1].crowd THEN CAST([] AS BIGINT[]) ELSE [opts[1].ann] END AS taken
  FROM todo WHERE rk = 1
  UNION ALL
  SELECT iou_threshold, area_range, image_id, category_id, rk, det_id, score, det_area, low, high, pick,
         CASE WHEN pick IS NULL OR pick.crowd THEN taken ELSE list_append(taken, pick.ann) END
  FROM (SELECT n.*, p.taken, list_filter(n.opts, lambda o: o.crowd OR NOT list_contains(p.taken, o.ann))[1] AS pick
        FROM pass p JOIN todo n ON n.rk = p.rk + 1 AND n.image_id = p.image_id AND n.category_id = p.category_id
         AND n.area_range = p.area_range AND n.iou_threshold = p.iou_threshold))"""

_COCO_FULL = """
flags AS (
  SELECT iou_threshold, area_range, category_id, det_id, score, rk,
         CAST(pick IS NOT NULL AND NOT pick.ign AS INT) AS is_tp,
         CAST(pick IS NULL AND NOT (det_area < low OR det_area > high) AS INT) AS is_fp
  FROM pass),
npos AS (
  SELECT category_id, area_range, count(*) FILTER (WHERE iscrowd = 0 AND AREA >= low AND AREA <= high) AS npos
  FROM t CROSS JOIN (SELECT DISTINCT area_range, low, high FROM configs) GROUP BY ALL),
curve AS (
  SELECT *, tp / npos AS recall, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision
  FROM (SELECT *, sum(is_tp) OVER w AS tp, sum(is_fp) OVER w AS fp FROM flags JOIN npos USING (category_id, area_range)
        WINDOW w AS (PARTITION BY iou_threshold, area_range, category_id ORDER BY score DESC, det_id ROWS UNBOUNDED PRECEDING))),
sampled AS (
  SELECT iou_threshold, area_range, category_id, i, coalesce(max(precision) FILTER (WHERE recall >= i * 0.01), 0) AS p
  FROM curve CROSS JOIN (SELECT CAST(unnest(range(101)) AS DOUBLE) AS i) GROUP BY ALL),
ap AS (SELECT iou_threshold, area_range, category_id, avg(p) AS ap FROM sampled GROUP BY ALL),
ar AS (
  SELECT iou_threshold, area_range, category_id, m, sum(is_tp) FILTER (WHERE rk <= m) / any_value(npos) AS ar
  FROM curve CROSS JOIN (SELECT unnest([1, 10, 100]) AS m) GROUP BY ALL)"""

_FULL_CONFIGS = (
    "SELECT thr, nm, lo, hi FROM (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]) AS thr) "
    "CROSS JOIN (VALUES ('all', 0.0::DOUBLE, 1e10), ('small', 0.0, 1024.0), ('medium', 1024.0, 9216.0), ('large', 9216.0, 1e10)) v(nm, lo, hi)"
)
_TWO_CONFIGS = "SELECT * FROM (VALUES (0.5::DOUBLE, 'all', 0.0::DOUBLE, 1e10), (0.5, 'medium', 1024.0, 9216.0))"


def _coco(
    tail: str, configs: str, truths: str = "SELECT * FROM annotations", dets: str = "SELECT * FROM detections", iou: str = _CROWD_IOU, area: str = "box_area"
) -> str:
    """The evaluator's SQL over ``truths`` and ``dets``; ``area`` is the column that decides the area range."""
    boxed = "SELECT *, w*h AS box_area FROM ({})"
    text = f"WITH {_COCO_PASS}{tail}"
    for name, value in (("TRUTHS", boxed.format(truths)), ("DETS", boxed.format(dets)), ("CONFIGS", configs), ("PAIRIOU", iou), ("AREA", area)):
        text = text.replace(name, value)
    return fx.with_ctes(text, "annotations", "detections", "categories", "images", recursive=True)


_SUMMARY_ROWS = [
    ("AP", "ap", "all", 100, None),
    ("AP50", "ap", "all", 100, 0.5),
    ("AP75", "ap", "all", 100, 0.75),
    ("AP_small", "ap", "small", 100, None),
    ("AP_medium", "ap", "medium", 100, None),
    ("AP_large", "ap", "large", 100, None),
    ("AR_1", "ar", "all", 1, None),
    ("AR_10", "ar", "all", 10, None),
    ("AR_100", "ar", "all", 100, None),
    ("AR_small", "ar", "small", 100, None),
    ("AR_medium", "ar", "medium", 100, None),
    ("AR_large", "ar", "large", 100, None),
]


def _summary_row(metric, kind, area, m, iou):
    cap = f"AND m = {m}" if kind == "ar" else ""
    at = f"AND iou_threshold = {iou}" if iou else ""
    return f"SELECT '{metric}' AS metric, round(avg({kind}), 6) AS value FROM {kind} WHERE area_range = '{area}' {cap} {at}"


SQL = {
    "iou_join": fx.with_ctes(
        f"SELECT d.image_id, d.det_id, a.ann_id, round({_iou('d', 'a')}, 6) AS iou FROM detections d JOIN annotations a ON d.image_id = a.image_id WHERE {_iou('d', 'a')} > 0",
        "annotations",
        "detections",
    ),
    "iou_join_pixel": fx.with_ctes(
        f"""SELECT d.image_id, count(*) AS pairs, round(max({_iou('d', 'a', '1')}), 11) AS iou_max
        FROM detections d JOIN annotations a ON d.image_id = a.image_id AND d.category_id = a.category_id
        WHERE {_iou('d', 'a', '1')} > 0 GROUP BY 1""",
        "annotations",
        "detections",
    ),
    "mask_iou_join": fx.with_ctes(
        f"SELECT d.image_id, d.det_id AS a_mask, a.ann_id AS b_mask, round({_iou('d', 'a')}, 6) AS iou FROM detections d JOIN annotations a ON d.image_id = a.image_id WHERE {_iou('d', 'a')} > 0",
        "annotations",
        "detections",
    ),
    "mutual_best_match": fx.with_ctes(
        f"WITH {_MUTUAL.replace('MINSCORE', '-1')} SELECT image_id, ann_id, det_id, round(iou, 6) AS iou, true_category, pred_category FROM mutual",
        "annotations",
        "detections",
    ),
    "voc_match": _voc(" SELECT det_id, ann_id, outcome FROM outcomes"),
    "pr_curve": _voc(f", {_CURVE} SELECT category_id, det_id, tp, fp, round(recall, 6) AS recall, round(precision, 6) AS precision FROM points"),
    "average_precision": _voc(
        f""", {_CURVE}, {_AREA}
        SELECT 'area' AS method, category_id, round(ap, 6) AS ap FROM area
        UNION ALL
        SELECT 'voc07', category_id, round(sum(p) / 11, 6) FROM (
          SELECT category_id, i, coalesce(max(precision) FILTER (WHERE recall >= i * 0.1), 0) AS p
          FROM points CROSS JOIN (SELECT CAST(unnest(range(11)) AS DOUBLE) AS i) GROUP BY 1, 2) GROUP BY 2
        UNION ALL
        SELECT 'coco', category_id, round(avg(p), 6) FROM (
          SELECT category_id, i, coalesce(max(precision) FILTER (WHERE recall >= i * 0.01), 0) AS p
          FROM points CROSS JOIN (SELECT CAST(unnest(range(101)) AS DOUBLE) AS i) GROUP BY 1, 2) GROUP BY 2"""
    ),
    "coco_match": _coco(" SELECT area_range, det_id, pick.ann AS ann_id, pick.ign AS ann_ignored FROM pass WHERE pick IS NOT NULL", _TWO_CONFIGS),
    "detection_summary": _coco(f", {_COCO_FULL} {' UNION ALL '.join(_summary_row(*r) for r in _SUMMARY_ROWS)}", _FULL_CONFIGS),
    "per_class_table": _coco(
        f""", {_COCO_FULL}
        SELECT name, round(100 * (SELECT avg(ap) FROM ap WHERE ap.category_id = c.category_id AND area_range = 'all'), 5) AS ap,
               round(100 * (SELECT avg(ar) FROM ar WHERE ar.category_id = c.category_id AND area_range = 'all' AND m = 100), 5) AS ar
        FROM categories c""",
        _FULL_CONFIGS,
    ),
    "detection_confusion": _confusion(
        "SELECT true_category, pred_category, count(*) AS n, count(DISTINCT image_id) AS images FROM cases GROUP BY 1, 2"
    ),
    "detection_confusion_strict": _confusion("SELECT true_category, pred_category, count(*) AS n FROM cases GROUP BY 1, 2", strict=True),
    "confusion_files": _confusion(
        "SELECT DISTINCT true_category, pred_category, file_name FROM cases JOIN images USING (image_id)"
    ),
    "per_image_confusion": _confusion(
        """, sides AS (
          SELECT image_id, true_category AS category_id, CAST(true_category = pred_category AS INT) AS tp, 0 AS fp,
                 CAST(pred_category = 0 AS INT) AS fn, 1 AS objects, 0 AS predictions FROM cases WHERE true_category <> 0
          UNION ALL
          SELECT image_id, pred_category, 0, CAST(true_category <> pred_category AS INT), 0, 0, 1 FROM cases WHERE pred_category <> 0)
        SELECT image_id, category_id, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
               CAST(sum(objects) AS BIGINT) AS objects, CAST(sum(predictions) AS BIGINT) AS predictions
        FROM sides GROUP BY 1, 2"""
    ),
    "nms_per_class": _nms("image_id, category_id", "0.1", "1", "> 0.1"),
    "nms_per_class_rounds": _nms("image_id, category_id", "0.1", "1", "> 0.1"),
    "nms_agnostic": _nms("image_id", "0.05", "0", ">= 0.2").replace("SELECT image_id, det_id", "SELECT image_id, det_id"),
}

_MAP_PARTS = " UNION ALL ".join(
    f"SELECT {t} AS thr, ap FROM ({_voc(f', {_CURVE}, {_AREA} SELECT ap FROM area', str(t))})" for t in evaluate.IOU_THRESHOLDS
)
SQL["voc_summary"] = f"SELECT round(avg(ap), 6) AS map, round(avg(ap) FILTER (WHERE thr = 0.5), 6) AS map50 FROM ({_MAP_PARTS})"
