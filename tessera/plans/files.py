"""Registered queries: label text, records and round trips through files in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.operators.ordering import dense_id
from tessera.plans.tiling import OCTAGON, with_octagons
from tessera.session import stage_path
from tessera.sources import coco, labels, records
from tessera.sources import fixtures as fx


def _coco_tables(spark, sf):
    anns = with_octagons(fx.detections(spark, sf).withColumnRenamed("det_id", "ann_id"))
    return coco.CocoTables(fx.images(spark, sf), anns, fx.categories(spark, sf))


def coco_round_trip(spark, sf):
    """Tables written as COCO JSON lines and read back."""
    path = stage_path(spark, "coco-lines")
    coco.write_coco_lines(_coco_tables(spark, sf), path, compression="gzip")
    back = coco.read_coco_lines(spark, path)
    # polygons are counted where they are read, so the joins move a number for each
    counted = back.annotations.withColumn("numbers", F.size(F.col("segmentation")[0])).drop("segmentation")
    named = counted.join(back.images, "image_id").join(back.categories, "category_id")
    return named.select("ann_id", "file_name", "name", "x", "y", "w", "h", "area", "score", "numbers")


def write_yolo_detection(spark, sf):
    lines = records.yolo_detection_lines(fx.annotations(spark, sf), fx.images(spark, sf))
    return records.text_blocks(lines, ["label_file"], ["ann_id"])


def write_yolo_detection_ordered(spark, sf):
    lines = records.yolo_detection_lines(fx.annotations(spark, sf), fx.images(spark, sf), [5, 4, 3, 2, 1])
    return lines.select("ann_id", "line")


def write_yolo_segmentation(spark, sf):
    lines = records.yolo_segmentation_lines(with_octagons(fx.annotations(spark, sf)), fx.images(spark, sf))
    return lines.select("ann_id", "label_file", "line")


def read_yolo_labels(spark, sf):
    """Detections written as label lines and parsed again."""
    det = fx.detections(spark, sf)
    line = F.concat_ws(" ", "category_id", "x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h"), "score")
    path = stage_path(spark, "yolo-lines")
    det.select((F.col("image_id") % 8).alias("part"), line.alias("value")).write.partitionBy("part").text(path)
    back = labels.read_yolo_labels(spark, path)
    return back.select("class_id", "x1", "y1", "x2", "y2", "confidence")


def write_voc_results(spark, sf):
    return records.voc_result_lines(fx.detections(spark, sf), fx.images(spark, sf))


def read_voc_results(spark, sf):
    path = stage_path(spark, "voc-results")
    lines = records.voc_result_lines(fx.detections(spark, sf), fx.images(spark, sf))
    labels.write_line_files(lines, path, "category_id")
    return labels.read_voc_results(spark, path).select("category_id", "image_key", "score", "x1", "y1", "x2", "y2")


def write_metadata_jsonl(spark, sf):
    rows = records.metadata_records(fx.images(spark, sf), fx.annotations(spark, sf))
    text = F.concat_ws(",", F.transform("objects.id", lambda v: v.cast("string")))
    return rows.select("file_name", "image_id", "width", "height", text.alias("ids"), F.size("objects.bbox").alias("n"))


def write_ocr_boxes(spark, sf):
    anns = fx.annotations(spark, sf).withColumns({c: F.col(c).cast("int") for c in "xywh"})
    runs = sampling.consecutive_runs(anns, ["ann_id"])
    return records.ocr_box_lines(runs, fx.images(spark, sf), fx.categories(spark, sf), "images").select("run", "line")


def write_ocr_texts(spark, sf):
    docs = dense_id(fx.table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit(" "), "source").alias("text")), ["doc_id"], "n")
    return records.ocr_text_lines(docs, "texts")


def write_class_partitions(spark, sf):
    return records.class_partitions(fx.annotations(spark, sf), fx.images(spark, sf), fx.categories(spark, sf))


def export_detection_examples(spark, sf):
    out = records.detection_examples(fx.detections(spark, sf).withColumnRenamed("det_id", "ann_id"), fx.images(spark, sf), fx.categories(spark, sf))

    def total(c):
        return F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 10)

    return out.select(
        "image_id", "file_name", "format", "width",
        *[total(c).alias(f"{c}_sum") for c in ("xmin", "xmax", "ymin", "ymax")],
        F.array_join("class_text", ",").alias("class_text"),
        F.array_join(F.transform("class_id", lambda v: v.cast("string")), ",").alias("class_id"),
    )


def read_metric_csv(spark, sf):
    """Event values written as padded text, some of it no number, and read back."""
    path = stage_path(spark, "metrics")
    raw = fx.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("epoch"),
        F.when(F.col("event_id") % 6 == 0, F.lit("nan?")).otherwise(F.col("value").cast("string")).alias("loss"),
    )
    labels.write_metric_csv(raw, ["epoch", "loss"], path)
    return labels.read_metric_csv(spark, path, ["epoch", "loss"])


_QUERY_NAMES = (
    "coco_round_trip write_yolo_detection write_yolo_detection_ordered write_yolo_segmentation read_yolo_labels write_voc_results "
    "read_voc_results write_metadata_jsonl write_ocr_boxes write_ocr_texts write_class_partitions export_detection_examples read_metric_csv"
).split()
QUERIES = {n: globals()[n] for n in _QUERY_NAMES}

_YOLO = "CAST((2*x + w)/(2*width) AS VARCHAR) || ' ' || CAST((2*y + h)/(2*height) AS VARCHAR) || ' ' || CAST(w/width AS VARCHAR) || ' ' || CAST(h/height AS VARCHAR)"
_RING = "[x + w*0.25, y, x + w*0.75, y, x + w, y + h*0.25, x + w, y + h*0.75, x + w*0.75, y + h, x + w*0.25, y + h, x, y + h*0.75, x, y + h*0.25]"
_UNIT = {"xmin": "x/width", "xmax": "(x + w)/width", "ymin": "y/height", "ymax": "(y + h)/height"}

SQL = {
    "coco_round_trip": fx.with_ctes(
        """SELECT det_id AS ann_id, file_name, name, x, y, w, h, w*h AS area, score, 16 AS numbers
        FROM detections JOIN images USING (image_id) JOIN categories USING (category_id)""",
        "detections", "images", "categories",
    ),
    "write_yolo_detection": fx.with_ctes(
        f"""SELECT 'img_' || image_id || '.txt' AS label_file, CAST(0 AS BIGINT) AS part, string_agg(category_id || ' ' || {_YOLO}, chr(10) ORDER BY ann_id) AS text
        FROM annotations JOIN images USING (image_id) GROUP BY image_id""",
        "annotations", "images",
    ),
    "write_yolo_detection_ordered": fx.with_ctes(
        f"SELECT ann_id, (5 - category_id) || ' ' || {_YOLO} AS line FROM annotations JOIN images USING (image_id)", "annotations", "images"
    ),
    "write_yolo_segmentation": fx.with_ctes(
        f"""WITH j AS (SELECT *, {_RING} AS ring FROM annotations JOIN images USING (image_id))
        SELECT ann_id, 'img_' || image_id || '.txt' AS label_file,
               category_id || ' ' || array_to_string([CAST(ring[i] / CASE WHEN i % 2 = 1 THEN width ELSE height END AS VARCHAR) FOR i IN range(1, 17)], ' ') AS line FROM j""",
        "annotations", "images",
    ),
    "read_yolo_labels": fx.with_ctes("SELECT category_id AS class_id, x AS x1, y AS y1, x + w AS x2, y + h AS y2, score AS confidence FROM detections", "detections"),
    "write_voc_results": fx.with_ctes(
        """SELECT category_id, det_id, printf('img_%d %.3f %.1f %.1f %.1f %.1f', image_id, score, x + 1, y + 1, x + w + 1, y + h + 1) AS line FROM detections""", "detections"
    ),
    "read_voc_results": fx.with_ctes(
        """SELECT category_id, 'img_' || image_id AS image_key, CAST(printf('%.3f', score) AS DOUBLE) AS score, x + 1 AS x1, y + 1 AS y1, x + w + 1 AS x2, y + h + 1 AS y2
        FROM detections""",
        "detections",
    ),
    "write_metadata_jsonl": fx.with_ctes(
        """SELECT file_name, image_id, width, height, coalesce(string_agg(CAST(ann_id AS VARCHAR), ',' ORDER BY ann_id), '') AS ids, CAST(count(ann_id) AS INT) AS n
        FROM images LEFT JOIN annotations USING (image_id) GROUP BY ALL""",
        "images", "annotations",
    ),
    "write_ocr_boxes": fx.with_ctes(
        """WITH p AS (SELECT image_id, ann_id, '{"transcription":"' || name || '","points":[[' || CAST(x AS INT) || ',' || CAST(y AS INT) || '],[' || CAST(x + w AS INT) || ',' || CAST(y AS INT)
          || '],[' || CAST(x + w AS INT) || ',' || CAST(y + h AS INT) || '],[' || CAST(x AS INT) || ',' || CAST(y + h AS INT) || ']]}' AS item
          FROM annotations JOIN categories USING (category_id))
        SELECT row_number() OVER (ORDER BY image_id) AS run, 'images/img_' || image_id || '.jpg' || chr(9) || '[' || string_agg(item, ',' ORDER BY ann_id) || ']' AS line
        FROM p GROUP BY image_id""",
        "annotations", "categories",
    ),
    "write_ocr_texts": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n,
        'texts/img_' || (row_number() OVER (ORDER BY doc_id) - 1) || '.png' || chr(9) || lang || ' ' || source AS line FROM documents""",
    "write_class_partitions": fx.with_ctes(
        """WITH f AS (SELECT image_id, arg_min(category_id, ann_id) AS category_id, count(*) > 1 AS ambiguous FROM annotations GROUP BY 1)
        SELECT image_id, file_name, name AS label, ambiguous FROM f JOIN images USING (image_id) JOIN categories USING (category_id)""",
        "annotations", "images", "categories",
    ),
    "export_detection_examples": fx.with_ctes(
        "SELECT image_id, file_name, 'jpg' AS format, width, "
        + ", ".join(f"round(sum(least(greatest({e}, 0), 1)), 10) AS {n}_sum" for n, e in _UNIT.items())
        + """, string_agg(name, ',' ORDER BY det_id) AS class_text, string_agg(CAST(category_id AS VARCHAR), ',' ORDER BY det_id) AS class_id
        FROM detections JOIN images USING (image_id) JOIN categories USING (category_id) GROUP BY 1, 2, 3, 4""",
        "detections", "images", "categories",
    ),
    "read_metric_csv": "SELECT CAST(event_id AS DOUBLE) AS epoch, CASE WHEN event_id % 6 = 0 THEN 0.0 ELSE value END AS loss FROM events",
}
