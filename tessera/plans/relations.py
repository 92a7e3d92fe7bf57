"""Registered queries: joins and label sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import relate
from tessera.sources import fixtures as fx


def enrich_annotations(spark, sf):
    out = relate.enrich_annotations(fx.annotations(spark, sf), fx.images(spark, sf), fx.categories(spark, sf))
    return out.select("ann_id", "image_id", "file_name", "width", "height", "label")


def enrich_one_label(spark, sf):
    out = relate.enrich_annotations(fx.annotations(spark, sf), fx.images(spark, sf), fx.categories(spark, sf), only_label="ASIA")
    return out.select("ann_id", "file_name", "label")


def _names(spark, sf):
    """Image names asked for; every ninth does not exist."""
    return fx.images(spark, sf).select(
        F.when(F.col("image_id") % 9 == 0, F.concat(F.lit("no_"), "file_name")).otherwise(F.col("file_name")).alias("file_name")
    )


def lookup_by_filename(spark, sf):
    return relate.lookup_by_filename(_names(spark, sf), fx.images(spark, sf), "null")


def lookup_by_filename_drop(spark, sf):
    return relate.lookup_by_filename(_names(spark, sf), fx.images(spark, sf), "drop")


def pair_images_masks(spark, sf):
    images = fx.images(spark, sf).select(F.concat(F.lit("orig - DS"), "image_id", F.lit(".jpg")).alias("file_name"))
    masks = fx.images(spark, sf).filter("image_id % 3 <> 0").select(F.concat(F.lit("mask - DS"), "image_id", F.lit(".png")).alias("mask_name"))
    return relate.pair_images_masks(images, masks, "orig - ", "mask - ").select("file_name", "mask_name", "new_mask_name")


def pair_labels_masks(spark, sf):
    labels = fx.annotations(spark, sf).select(F.col("image_id").cast("string").alias("image_key"), (F.col("ann_id") % 10 - 1).alias("line_no"), "ann_id")
    masks = fx.annotations(spark, sf).filter("ann_id % 10 <= 3").select(
        F.concat("image_id", F.lit("_"), F.col("ann_id") % 10 - 1, F.lit(".png")).alias("mask_name")
    ).distinct()
    return relate.pair_labels_masks(labels, masks).select("ann_id", "mask_name")


def anti_join_annotated(spark, sf):
    return relate.anti_join_annotated(fx.images(spark, sf), fx.annotations(spark, sf)).select("image_id", "file_name")


def semi_join_present(spark, sf):
    return relate.semi_join_present(fx.images(spark, sf), fx.detections(spark, sf)).select("image_id", "file_name")


def class_of_pixel(spark, sf):
    """Grey runs derived from the annotations: value, length."""
    runs = fx.annotations(spark, sf).select("image_id", (F.col("ann_id") % 256).cast("int").alias("value"), F.col("w").alias("length"))
    classed = relate.class_of_pixel(runs, fx.categories(spark, sf))
    return classed.groupBy("image_id", "category_id", "label").agg(F.sum("length").alias("pixels"))


def class_of_pixel_exact(spark, sf):
    runs = fx.annotations(spark, sf).select((F.col("ann_id") % 256).cast("int").alias("value"), F.col("w").alias("length"))
    return relate.class_of_pixel(runs, fx.categories(spark, sf), exact=True).groupBy("category_id").agg(F.sum("length").alias("pixels"))


def fuzzy_label_match(spark, sf):
    """Nation names matched to region names."""
    names = fx.table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    labels = fx.table(spark, sf, "region").select(F.col("r_regionkey").alias("label_pos"), F.col("r_name").alias("label"))
    return relate.fuzzy_label_match(names, labels)


def label_id_ignoring_case(spark, sf):
    names = fx.table(spark, sf, "part").select(F.lower(F.substring("p_name", 1, 4)).alias("name"), "p_partkey")
    labels = (
        fx.table(spark, sf, "part").filter("p_partkey % 2 = 0").groupBy(F.upper(F.substring("p_name", 1, 4)).alias("label"))
        .agg(F.min("p_partkey").alias("label_id")).withColumn("label_pos", F.col("label_id"))
    )
    return relate.label_id_ignoring_case(names, labels).select("p_partkey", "label_id")


def apply_labelmap(spark, sf):
    dets = fx.detections(spark, sf).withColumnRenamed("category_id", "class_idx")
    labelmap = fx.categories(spark, sf).select((F.col("category_id") - 1).alias("class_idx"), F.col("name").alias("label")).filter("class_idx < 4")
    shift = relate.labelmap_shift(labelmap)
    return relate.apply_labelmap(dets, labelmap, shift, "drop").select("det_id", "label")


def _model_labels(spark, sf):
    """Two known labels and the part brands: labels a model knows, in order."""
    known = fx.table(spark, sf, "region").filter("r_regionkey < 2").select(F.col("r_name").alias("label"), F.col("r_regionkey").alias("label_pos"))
    brands = fx.table(spark, sf, "part").groupBy(F.col("p_brand").alias("label")).agg((F.min("p_partkey") + 100).alias("label_pos"))
    return known.unionByName(brands)


def _dataset_labels(spark, sf):
    return fx.table(spark, sf, "region").select((F.col("r_regionkey") + 1).cast("long").alias("label_id"), F.col("r_name").alias("label"))


def label_overlap(spark, sf):
    return relate.label_overlap(_model_labels(spark, sf), _dataset_labels(spark, sf))


def labels_equal(spark, sf):
    model, dataset = _model_labels(spark, sf), _dataset_labels(spark, sf)
    rows = [("model", relate.labels_equal(model, dataset)), ("itself", relate.labels_equal(dataset, dataset))]
    sides = dataset.limit(1)
    return sides.select(F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.lit(v).alias("equal")) for n, v in rows])).alias("_r")).select("_r.*")


def add_missing_labels(spark, sf):
    return relate.add_missing_labels(_dataset_labels(spark, sf), _model_labels(spark, sf))


def union_datasets(spark, sf):
    first = fx.annotations(spark, sf).select("ann_id", "image_id", "category_id")
    second = fx.detections(spark, sf).select(F.col("det_id").alias("ann_id"), "image_id", "category_id", "score")
    out = relate.union_datasets(first, second, ("labels", "model"), ["ann_id"], "ann_id")
    return out.select("ann_id", "source_ann_id", "source", "image_id", "score")


QUERIES = {
    "enrich_annotations": enrich_annotations,
    "enrich_one_label": enrich_one_label,
    "lookup_by_filename": lookup_by_filename,
    "lookup_by_filename_drop": lookup_by_filename_drop,
    "pair_images_masks": pair_images_masks,
    "pair_labels_masks": pair_labels_masks,
    "anti_join_annotated": anti_join_annotated,
    "semi_join_present": semi_join_present,
    "class_of_pixel": class_of_pixel,
    "class_of_pixel_exact": class_of_pixel_exact,
    "fuzzy_label_match": fuzzy_label_match,
    "label_id_ignoring_case": label_id_ignoring_case,
    "apply_labelmap": apply_labelmap,
    "label_overlap": label_overlap,
    "labels_equal": labels_equal,
    "add_missing_labels": add_missing_labels,
    "union_datasets": union_datasets,
}

_NAMES = "names AS (SELECT CASE WHEN image_id % 9 = 0 THEN 'no_' || file_name ELSE file_name END AS file_name FROM images)"
_MODEL = """
model AS (SELECT r_name AS label, r_regionkey AS label_pos FROM region WHERE r_regionkey < 2
          UNION ALL SELECT p_brand, min(p_partkey) + 100 FROM part GROUP BY 1),
dataset AS (SELECT CAST(r_regionkey + 1 AS BIGINT) AS label_id, r_name AS label FROM region)"""

SQL = {
    "enrich_annotations": fx.with_ctes(
        "SELECT ann_id, image_id, file_name, width, height, name AS label FROM annotations JOIN images USING (image_id) JOIN categories USING (category_id)",
        "annotations", "images", "categories",
    ),
    "enrich_one_label": fx.with_ctes(
        "SELECT ann_id, file_name, name AS label FROM annotations JOIN images USING (image_id) JOIN categories USING (category_id) WHERE name = 'ASIA'",
        "annotations", "images", "categories",
    ),
    "lookup_by_filename": fx.with_ctes(f"WITH {_NAMES} SELECT n.file_name, image_id FROM names n LEFT JOIN images i ON n.file_name = i.file_name", "images"),
    "lookup_by_filename_drop": fx.with_ctes(f"WITH {_NAMES} SELECT n.file_name, image_id FROM names n JOIN images i ON n.file_name = i.file_name", "images"),
    "pair_images_masks": fx.with_ctes(
        """SELECT 'orig - DS' || image_id || '.jpg' AS file_name, 'mask - DS' || image_id || '.png' AS mask_name,
        'orig -' || ' DS' || image_id || '.png' AS new_mask_name FROM images WHERE image_id % 3 <> 0""",
        "images",
    ),
    "pair_labels_masks": fx.with_ctes(
        """SELECT a.ann_id, m.mask_name FROM annotations a JOIN (
          SELECT DISTINCT image_id, ann_id % 10 - 1 AS pos, image_id || '_' || (ann_id % 10 - 1) || '.png' AS mask_name FROM annotations WHERE ann_id % 10 <= 3) m
        ON a.image_id = m.image_id AND a.ann_id % 10 - 1 = m.pos""",
        "annotations",
    ),
    "anti_join_annotated": fx.with_ctes("SELECT image_id, file_name FROM images WHERE image_id NOT IN (SELECT image_id FROM annotations)", "images", "annotations"),
    "semi_join_present": fx.with_ctes("SELECT image_id, file_name FROM images WHERE image_id IN (SELECT image_id FROM detections)", "images", "detections"),
    "class_of_pixel": fx.with_ctes(
        """SELECT image_id, c.category_id, name AS label, sum(w) AS pixels FROM annotations a
        JOIN categories c ON ann_id % 256 BETWEEN 51*c.category_id - 17 AND 51*c.category_id + 17 GROUP BY ALL""",
        "annotations", "categories",
    ),
    "class_of_pixel_exact": fx.with_ctes(
        "SELECT c.category_id, sum(w) AS pixels FROM annotations a JOIN categories c ON ann_id % 256 = 51*c.category_id GROUP BY ALL",
        "annotations", "categories",
    ),
    # longest common subsequence by a fold over the characters; a row's running maximum is its prefix maximum
    "fuzzy_label_match": """
        WITH pairs AS (SELECT DISTINCT n_name AS name, r_regionkey AS pos, r_name AS label, string_split(r_name, '') AS b FROM nation CROSS JOIN region),
        lcs AS (
          SELECT name, pos, label, list_reduce(
            list_prepend([0 FOR c IN b], list_transform(string_split(name, ''), lambda ch: [CAST(unicode(ch) AS INT)])),
            lambda row, ch: list_transform(range(1, len(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k:
              greatest(row[k], (CASE WHEN k > 1 THEN row[k - 1] ELSE 0 END) + (CASE WHEN unicode(b[k]) = ch[1] THEN 1 ELSE 0 END)))))) AS last
          FROM pairs),
        scored AS (SELECT name, pos, label, CAST(round_even(200.0 * list_max(last) / (length(name) + length(label)), 0) AS INT) AS ratio FROM lcs)
        SELECT name, label, ratio FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ratio DESC, pos) AS nth FROM scored) WHERE nth = 1""",
    "label_id_ignoring_case": """
        WITH labels AS (SELECT upper(substr(p_name, 1, 4)) AS label, min(p_partkey) AS label_id FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)
        SELECT p_partkey, coalesce(label_id, -1) AS label_id FROM part LEFT JOIN labels ON upper(substr(p_name, 1, 4)) = label""",
    "apply_labelmap": fx.with_ctes(
        "SELECT det_id, name AS label FROM detections JOIN categories USING (category_id) WHERE category_id < 5", "detections", "categories"
    ),
    "label_overlap": f"""WITH {_MODEL}
        SELECT label, CASE WHEN m.label IS NULL THEN 'dataset_only' WHEN d.label IS NULL THEN 'model_only' ELSE 'common' END AS side
        FROM (SELECT DISTINCT label FROM model) m FULL JOIN (SELECT DISTINCT label FROM dataset) d USING (label)""",
    "labels_equal": f"""WITH {_MODEL}
        SELECT 'model' AS side, NOT EXISTS ((SELECT label FROM model EXCEPT SELECT label FROM dataset) UNION (SELECT label FROM dataset EXCEPT SELECT label FROM model)) AS equal
        UNION ALL SELECT 'itself', true""",
    "add_missing_labels": f"""WITH {_MODEL}
        SELECT label_id, label FROM dataset UNION ALL
        SELECT (SELECT max(label_id) FROM dataset) + row_number() OVER (ORDER BY label_pos, label), label FROM model WHERE label NOT IN (SELECT label FROM dataset)""",
    "union_datasets": fx.with_ctes(
        """WITH both_sides AS (
          SELECT 0 AS pos, ann_id, 'labels' AS source, image_id, CAST(NULL AS DOUBLE) AS score FROM annotations
          UNION ALL SELECT 1, det_id, 'model', image_id, score FROM detections)
        SELECT row_number() OVER (ORDER BY pos, ann_id) AS ann_id, ann_id AS source_ann_id, source, image_id, score FROM both_sides""",
        "annotations", "detections",
    ),
}
