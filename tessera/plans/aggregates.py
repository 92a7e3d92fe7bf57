"""Registered queries: counts, reports, weights, histograms, ranks, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import metric_phase
from tessera.operators import nms, ordering, sampling, stats
from tessera.sources import fixtures as fx


def class_repartition(spark, sf):
    return stats.class_repartition(fx.annotations(spark, sf), fx.categories(spark, sf))


def class_repartition_by_size(spark, sf):
    sized = fx.annotations(spark, sf).join(fx.images(spark, sf).select("image_id", "width"), "image_id")
    rare = sized.filter("NOT (width = 640 AND category_id = 3)")
    return stats.class_repartition(rare, fx.categories(spark, sf), by=["width"])


def objects_per_image(spark, sf):
    from tessera.sources.records import objects_per_image as build

    rows = build(fx.annotations(spark, sf))
    text = lambda c: F.concat_ws(",", F.transform(c, lambda v: v.cast("string")))
    return rows.select(
        "image_id",
        text(F.col("objects.id")).alias("ids"),
        text(F.col("objects.category")).alias("categories"),
        text(F.transform("objects.area", lambda v: v.cast("long"))).alias("areas"),
        text(F.transform(F.flatten("objects.bbox"), lambda v: v.cast("long"))).alias("boxes"),
    )


def consecutive_runs(spark, sf):
    """File order by ann_id modulo a prime, so images come back in several runs."""
    rows = fx.annotations(spark, sf).select("ann_id", (F.col("image_id") % 3).alias("image_id"), (F.col("ann_id") % 9973).alias("place"))
    runs = sampling.consecutive_runs(rows, ["place", "ann_id"])
    return runs.groupBy("run", "image_id").agg(F.count(F.lit(1)).alias("n"), F.min("ann_id").alias("first_ann"))


def _class_pairs(spark, sf):
    """True class: the order's priority; predicted: its status and priority mixed."""
    return fx.table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 5).cast("int").alias("true_class"),
        F.when(F.col("l_suppkey") % 4 == 0, (F.col("l_partkey") + F.col("l_linenumber")) % 5).otherwise(F.col("l_partkey") % 5).cast("int").alias("pred_class"),
    )


def confusion_matrix(spark, sf):
    return stats.confusion_grid(_class_pairs(spark, sf))


def classification_report(spark, sf):
    report = stats.classification_report(_class_pairs(spark, sf))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


def class_scores(spark, sf):
    scores = stats.class_scores(_class_pairs(spark, sf))
    return scores.select("class", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round("f1", 6).alias("f1"), "support")


def micro_scores(spark, sf):
    values = fx.table(spark, sf, "labels").select(
        "quality", F.col("toxic").cast("double").alias("target"), (((F.col("doc_id") * 37) % 101) / 100).alias("score")
    )
    out = stats.micro_scores(values, ["quality"])
    return out.select("quality", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def class_weights(spark, sf):
    out = stats.class_weights(fx.annotations(spark, sf))
    return out.select("category_id", "n", F.round("weight", 6).alias("weight"))


def class_weights_detector(spark, sf):
    ap = fx.categories(spark, sf).select("category_id", (F.col("category_id") / 10.0).cast("double").alias("ap"))
    out = stats.class_weights(fx.annotations(spark, sf).filter("category_id <> 4"), fx.categories(spark, sf), ap)
    return out.select("category_id", "n", F.round("weight", 6).alias("weight"))


def image_weights(spark, sf):
    annotations = fx.annotations(spark, sf)
    out = stats.image_weights(annotations, stats.class_weights(annotations))
    return out.select("image_id", F.round("weight", 6).alias("weight"))


def _centres(spark, sf):
    return fx.annotations(spark, sf).select("ann_id", (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy"), "w", "h")


def dataset_statistics(spark, sf):
    return stats.histograms(_centres(spark, sf), ["cx", "cy", "w", "h"], 50)


def histogram_2d(spark, sf):
    return stats.histogram_2d(_centres(spark, sf), "cx", "cy", 100)


def log_density(spark, sf):
    out = stats.log_density(_centres(spark, sf), "cx", "cy", 100)
    return out.select("ann_id", F.round("log_density", 6).alias("log_density"))


def target_moments(spark, sf):
    out = stats.target_moments(_centres(spark, sf), ["cx", "cy", "w", "h"])
    return out.select("variable", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def job_counters(spark, sf):
    """Counters gathered while the rows pass, reported as a table."""
    dets = fx.detections(spark, sf)
    watched, seen = stats.job_counters(dets, "job", {"added": F.col("score") >= 0.5, "skipped": F.col("score") < 0.5})
    watched.write.format("noop").mode("overwrite").save()
    got = seen.get
    one = fx.table(spark, sf, "region").filter("r_regionkey = 0")
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("counter"), F.lit(int(v)).cast("long").alias("n")) for k, v in sorted(got.items())])).alias("_r")).select("_r.*")


def validate_coco(spark, sf):
    """Detections checked as annotations against part of the images and categories."""
    anns = fx.detections(spark, sf).withColumnRenamed("det_id", "ann_id")
    images = fx.images(spark, sf).filter("image_id % 11 <> 0")
    categories = fx.categories(spark, sf).filter("category_id < 5")
    return stats.validate_coco(images, anns, categories, label="EUROPE", min_size=20.0)


def dense_id(spark, sf):
    out = ordering.dense_id(fx.annotations(spark, sf), ["image_id", F.col("w").desc(), "ann_id"], "new_id")
    return out.select("ann_id", "new_id")


def rank_in_group(spark, sf):
    out = ordering.rank_in_group(fx.annotations(spark, sf), ["category_id"], [F.col("w").desc(), "ann_id"], "rank")
    return out.select("ann_id", "category_id", "rank")


def cap_per_image(spark, sf):
    return nms.cap_per_image(fx.detections(spark, sf), 3, [F.col("score").desc(), F.col("det_id")]).select("image_id", "det_id", "score")


def top1_class(spark, sf):
    return nms.top1_class(fx.detections(spark, sf).select("image_id", F.col("category_id").alias("class_idx"), "score"))


def _epochs(spark, sf):
    """Daily fitness per event type: the epoch is the day, the fitness the mean value."""
    events = fx.table(spark, sf, "events").withColumn("epoch", F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("int"))
    return events.groupBy(F.col("event_type").alias("run"), "epoch").agg(F.round(F.avg("value"), 3).alias("fitness"), F.count(F.lit(1)).alias("n"))


def best_epoch(spark, sf):
    return stats.best_epoch(_epochs(spark, sf), ["run"])


def best_row(spark, sf):
    return stats.best_row(_epochs(spark, sf), ["run"])


def rolling_meters(spark, sf):
    """Values cut to quarters, so sums are exact in any order."""
    values = fx.table(spark, sf, "events").select(F.col("event_type").alias("name"), "event_id", (F.floor(F.col("value") * 4) / 4).alias("value"))
    return stats.rolling_meters(values, 20, ["name"], ["event_id"])


def batch_index(spark, sf):
    return ordering.batch_index(fx.images(spark, sf), ["image_id"], 64, drop_last=True).select("image_id", "batch")


def overlap_order(spark, sf):
    inst = fx.annotations(spark, sf).select("image_id", "ann_id", (F.col("w") * F.col("h")).alias("area"))
    return sampling.overlap_order(inst).select("image_id", "ann_id", "rank")


def split_dataset(spark, sf):
    annotated = fx.images(spark, sf).join(fx.annotations(spark, sf).select("image_id"), "image_id", "left_semi")
    return sampling.split_dataset(annotated, 0.8).select("image_id", "split")


def split_given_test(spark, sf):
    images = fx.images(spark, sf)
    named = {"train": images.filter("image_id % 4 <> 0"), "test": images.filter("image_id % 4 = 0")}
    return sampling.split_named(named, 0.7, seed="11").select("image_id", "split")


def split_repartition(spark, sf):
    split = sampling.split_dataset(fx.images(spark, sf), 0.7)
    joined = fx.annotations(spark, sf).join(split.select("image_id", "split"), "image_id")
    return stats.class_repartition(joined, fx.categories(spark, sf), by=["split"])


def sample_fraction(spark, sf):
    return sampling.sample_fraction(fx.images(spark, sf), 0.35).select("image_id", "chosen")


def weighted_resample(spark, sf):
    annotations = fx.annotations(spark, sf)
    weights = stats.image_weights(annotations, stats.class_weights(annotations))
    return sampling.weighted_resample(weights, weights.count())


def pick_partners(spark, sf):
    return sampling.pick_partners(fx.images(spark, sf), 3)


def pick_transform(spark, sf):
    return sampling.pick_transform(fx.images(spark, sf), ["rotate", "flip", "blur"]).select("image_id", "transform")


def route_metrics(spark, sf):
    """Event types as metric names with a value that is not always a number."""
    raw = fx.table(spark, sf, "events").select(
        "event_id",
        F.concat(F.element_at(F.array(F.lit("val/"), F.lit("metrics/"), F.lit("train/"), F.lit("lr/")), (F.col("event_id") % 4 + 1).cast("int")), "event_type").alias("name"),
        F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("text"),
    )
    numeric = raw.withColumn("value", F.col("text").try_cast("double")).filter(F.col("value").isNotNull())
    return numeric.select("event_id", "name", metric_phase(F.col("name")).alias("phase"), "value")


_NAMES = (
    "class_repartition class_repartition_by_size objects_per_image consecutive_runs confusion_matrix classification_report class_scores "
    "micro_scores class_weights class_weights_detector image_weights dataset_statistics histogram_2d log_density target_moments "
    "job_counters validate_coco dense_id rank_in_group cap_per_image top1_class best_epoch best_row rolling_meters batch_index "
    "overlap_order split_dataset split_given_test split_repartition sample_fraction weighted_resample pick_partners pick_transform route_metrics"
).split()
QUERIES = {n: globals()[n] for n in _NAMES}

_PAIRS = """pairs AS (SELECT CAST(l_partkey % 5 AS INT) AS t,
  CAST(CASE WHEN l_suppkey % 4 = 0 THEN (l_partkey + l_linenumber) % 5 ELSE l_partkey % 5 END AS INT) AS p FROM lineitem)"""
_SCORES = f"""{_PAIRS}, classes AS (SELECT DISTINCT t AS class FROM pairs UNION SELECT p FROM pairs),
sums AS (SELECT class, count(*) FILTER (WHERE t = class AND p = class) AS hit, count(*) FILTER (WHERE t = class) AS tn,
  count(*) FILTER (WHERE p = class) AS pn FROM classes CROSS JOIN pairs GROUP BY 1),
scores AS (SELECT class, CASE WHEN pn > 0 THEN hit / pn ELSE 0 END AS precision, CASE WHEN tn > 0 THEN hit / tn ELSE 0 END AS recall,
  CASE WHEN tn + pn > 0 THEN 2.0::DOUBLE * hit / (tn + pn) ELSE 0 END AS f1, tn AS support, hit FROM sums)"""
_CENTRES = "centres AS (SELECT ann_id, x + w/2 AS cx, y + h/2 AS cy, w, h FROM annotations)"


def _bin(c: str, bins: int) -> str:
    lo, hi = f"(SELECT min({c}) FROM centres)", f"(SELECT max({c}) FROM centres)"
    return f"CAST(least(greatest(floor(({c} - {lo}) / ({hi} - {lo}) * {bins}), 0), {bins - 1}) AS INT)"


def _hash(seed: str, id_col: str = "image_id") -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}|' || {id_col}), {id_col}) - 1"


_EPOCHS = """epochs AS (SELECT event_type AS run, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS epoch,
  round(avg(value), 3) AS fitness, count(*) AS n FROM events GROUP BY 1, 2)"""
_W = "w AS (SELECT category_id, count(*) AS n FROM annotations GROUP BY 1)"

SQL = {
    "class_repartition": fx.with_ctes(
        "SELECT category_id, name AS label, count(ann_id) AS n FROM categories LEFT JOIN annotations USING (category_id) GROUP BY 1, 2", "categories", "annotations"
    ),
    "class_repartition_by_size": fx.with_ctes(
        """WITH j AS (SELECT width, category_id FROM annotations JOIN images USING (image_id) WHERE NOT (width = 640 AND category_id = 3))
        SELECT s.width, c.category_id, c.name AS label, count(j.width) AS n FROM (SELECT DISTINCT width FROM j) s CROSS JOIN categories c
        LEFT JOIN j ON j.width = s.width AND j.category_id = c.category_id GROUP BY ALL""",
        "categories", "annotations", "images",
    ),
    "objects_per_image": fx.with_ctes(
        """SELECT image_id, string_agg(CAST(ann_id AS VARCHAR), ',' ORDER BY ann_id) AS ids, string_agg(CAST(category_id AS VARCHAR), ',' ORDER BY ann_id) AS categories,
        string_agg(CAST(CAST(w*h AS BIGINT) AS VARCHAR), ',' ORDER BY ann_id) AS areas,
        string_agg(CAST(x AS BIGINT) || ',' || CAST(y AS BIGINT) || ',' || CAST(w AS BIGINT) || ',' || CAST(h AS BIGINT), ',' ORDER BY ann_id) AS boxes
        FROM annotations GROUP BY 1""",
        "annotations",
    ),
    "consecutive_runs": fx.with_ctes(
        """WITH r AS (SELECT ann_id, image_id % 3 AS image_id, ann_id % 9973 AS place FROM annotations),
        l AS (SELECT *, lag(image_id) OVER (ORDER BY place, ann_id) AS prev FROM r),
        s AS (SELECT *, CAST(sum(CASE WHEN prev IS NOT DISTINCT FROM image_id THEN 0 ELSE 1 END) OVER (ORDER BY place, ann_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM l)
        SELECT run, image_id, count(*) AS n, min(ann_id) AS first_ann FROM s GROUP BY 1, 2""",
        "annotations",
    ),
    "confusion_matrix": f"""WITH {_PAIRS}, c AS (SELECT DISTINCT t AS c FROM pairs UNION SELECT p FROM pairs)
        SELECT a.c AS true_class, b.c AS pred_class, (SELECT count(*) FROM pairs WHERE t = a.c AND p = b.c) AS n FROM c a CROSS JOIN c b""",
    "classification_report": f"""WITH {_SCORES} SELECT round(sum(hit) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS macro_precision,
        round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM scores""",
    "class_scores": f"WITH {_SCORES} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores",
    "micro_scores": """WITH v AS (SELECT quality, CAST(toxic AS DOUBLE) AS y, CAST((doc_id * 37) % 101 AS DOUBLE) / 100 AS p FROM labels),
        s AS (SELECT quality, sum(round_even(y*p, 0)) AS tp, sum(y) AS pos, sum(round_even(p, 0)) AS pred FROM v GROUP BY 1),
        r AS (SELECT quality, tp / (pred + 1e-7) AS pr, tp / (pos + 1e-7) AS rc FROM s)
        SELECT quality, round(pr, 6) AS precision, round(rc, 6) AS recall, round(2 * pr * rc / (pr + rc + 1e-7), 6) AS f1 FROM r""",
    "class_weights": fx.with_ctes(
        f"WITH {_W} SELECT category_id, n, round(CAST((SELECT sum(n) FROM w) AS DOUBLE) / ((SELECT count(*) FROM w) * n), 6) AS weight FROM w", "annotations"
    ),
    "class_weights_detector": fx.with_ctes(
        """WITH w AS (SELECT category_id, count(ann_id) AS n FROM categories LEFT JOIN (SELECT * FROM annotations WHERE category_id <> 4) USING (category_id) GROUP BY 1),
        i AS (SELECT *, 1.0::DOUBLE / greatest(n, 1) AS inv FROM w)
        SELECT category_id, n, round(inv / (SELECT sum(inv) FROM i) * 5 * pow(1 - category_id / 10.0::DOUBLE, 2) / 5, 6) AS weight FROM i""",
        "annotations", "categories",
    ),
    "image_weights": fx.with_ctes(
        f"""WITH {_W}, cw AS (SELECT category_id, CAST((SELECT sum(n) FROM w) AS DOUBLE) / ((SELECT count(*) FROM w) * n) AS weight FROM w)
        SELECT image_id, round(sum(weight), 6) AS weight FROM annotations JOIN cw USING (category_id) GROUP BY 1""",
        "annotations",
    ),
    "dataset_statistics": fx.with_ctes(
        f"WITH {_CENTRES} " + " UNION ALL ".join(f"SELECT '{c}' AS variable, {_bin(c, 50)} AS bin, count(*) AS n FROM centres GROUP BY 2" for c in ("cx", "cy", "w", "h")),
        "annotations",
    ),
    "histogram_2d": fx.with_ctes(f"WITH {_CENTRES} SELECT {_bin('cx', 100)} AS bin_x, {_bin('cy', 100)} AS bin_y, count(*) AS n FROM centres GROUP BY 1, 2", "annotations"),
    "log_density": fx.with_ctes(
        f"""WITH {_CENTRES}, b AS (SELECT ann_id, {_bin('cx', 99)} AS bx, {_bin('cy', 99)} AS byy FROM centres)
        SELECT ann_id, round(ln(count(*) OVER (PARTITION BY bx, byy)), 6) AS log_density FROM b""",
        "annotations",
    ),
    "target_moments": fx.with_ctes(
        f"WITH {_CENTRES} " + " UNION ALL ".join(f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM centres" for c in ("cx", "cy", "w", "h")),
        "annotations",
    ),
    "job_counters": fx.with_ctes(
        """SELECT 'rows' AS counter, count(*) AS n FROM detections UNION ALL SELECT 'added', count(*) FROM detections WHERE score >= 0.5
        UNION ALL SELECT 'skipped', count(*) FROM detections WHERE score < 0.5""",
        "detections",
    ),
    "validate_coco": fx.with_ctes(
        """WITH i AS (SELECT * FROM images WHERE image_id % 11 <> 0), c AS (SELECT * FROM categories WHERE category_id < 5)
        SELECT 'invalid_box' AS rule, count(*) AS n FROM detections WHERE w < 20 OR h < 20 OR x < 0 OR y < 0
        UNION ALL SELECT 'unknown_image', count(*) FROM detections WHERE image_id NOT IN (SELECT image_id FROM i)
        UNION ALL SELECT 'unknown_category', count(*) FROM detections WHERE category_id NOT IN (SELECT category_id FROM c)
        UNION ALL SELECT 'class_beyond_count', count(*) FROM detections WHERE category_id > 4
        UNION ALL SELECT 'duplicate_annotation_id', count(*) - count(DISTINCT det_id) FROM detections
        UNION ALL SELECT 'duplicate_image_id', count(*) - count(DISTINCT image_id) FROM i
        UNION ALL SELECT 'too_few_images', CAST(count(*) < 2 AS BIGINT) FROM i
        UNION ALL SELECT 'label_absent', CAST(count(*) FILTER (WHERE name = 'EUROPE') = 0 AS BIGINT) FROM c""",
        "detections", "images", "categories",
    ),
    "dense_id": fx.with_ctes("SELECT ann_id, row_number() OVER (ORDER BY image_id, w DESC, ann_id) - 1 AS new_id FROM annotations", "annotations"),
    "rank_in_group": fx.with_ctes("SELECT ann_id, category_id, row_number() OVER (PARTITION BY category_id ORDER BY w DESC, ann_id) AS rank FROM annotations", "annotations"),
    "cap_per_image": fx.with_ctes(
        "SELECT image_id, det_id, score FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS nth FROM detections) WHERE nth <= 3", "detections"
    ),
    "top1_class": fx.with_ctes(
        """SELECT image_id, category_id AS class_idx, score FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, category_id) AS nth FROM detections) WHERE nth = 1""",
        "detections",
    ),
    "best_epoch": f"""WITH {_EPOCHS}, b AS (SELECT *, max(fitness) OVER (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS best_fitness FROM epochs)
        SELECT *, (SELECT min(epoch) FROM epochs e WHERE e.run = b.run AND e.fitness = b.best_fitness) AS best_epoch FROM b""",
    "best_row": f"WITH {_EPOCHS} SELECT run, epoch, fitness, n FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY fitness DESC, epoch) AS nth FROM epochs) WHERE nth = 1",
    "rolling_meters": """WITH v AS (SELECT event_type, event_id, floor(value * 4) / 4 AS value FROM events)
        SELECT event_type AS name, event_id, avg(value) OVER r AS avg, median(value) OVER r AS median, value AS latest,
        sum(value) OVER a AS total, avg(value) OVER a AS global_avg FROM v
        WINDOW r AS (PARTITION BY event_type ORDER BY event_id ROWS 19 PRECEDING), a AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
    "batch_index": fx.with_ctes(
        """WITH r AS (SELECT image_id, row_number() OVER (ORDER BY image_id) - 1 AS i FROM images)
        SELECT image_id, i // 64 AS batch FROM r WHERE i < (SELECT count(*) FROM images) // 64 * 64""",
        "images",
    ),
    "overlap_order": fx.with_ctes("SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY w*h DESC, ann_id) AS rank FROM annotations", "annotations"),
    "split_dataset": fx.with_ctes(
        f"""WITH a AS (SELECT image_id FROM images WHERE image_id IN (SELECT image_id FROM annotations)), n AS (SELECT count(*) AS n FROM a),
        r AS (SELECT image_id, {_hash('42')} AS i FROM a)
        SELECT image_id, CASE WHEN i < k THEN 'train' WHEN i < k + (n - k) // 2 THEN 'test' ELSE 'val' END AS split
        FROM r CROSS JOIN (SELECT n, CAST(trunc(n * 0.8::DOUBLE) AS BIGINT) AS k FROM n)""",
        "images", "annotations",
    ),
    "split_given_test": fx.with_ctes(
        f"""WITH a AS (SELECT image_id FROM images WHERE image_id % 4 <> 0), r AS (SELECT image_id, {_hash('11')} AS i FROM a)
        SELECT image_id, CASE WHEN i < trunc((SELECT count(*) FROM a) * 0.7::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM r
        UNION ALL SELECT image_id, 'test' FROM images WHERE image_id % 4 = 0""",
        "images",
    ),
    "split_repartition": fx.with_ctes(
        f"""WITH n AS (SELECT count(*) AS n FROM images), r AS (SELECT image_id, {_hash('42')} AS i FROM images),
        s AS (SELECT image_id, CASE WHEN i < k THEN 'train' WHEN i < k + (n - k) // 2 THEN 'test' ELSE 'val' END AS split
              FROM r CROSS JOIN (SELECT n, CAST(trunc(n * 0.7::DOUBLE) AS BIGINT) AS k FROM n))
        SELECT split, category_id, name AS label, count(*) AS n FROM annotations JOIN s USING (image_id) JOIN categories USING (category_id) GROUP BY ALL""",
        "images", "annotations", "categories",
    ),
    "sample_fraction": fx.with_ctes(
        f"WITH r AS (SELECT image_id, {_hash('7')} AS i FROM images) SELECT image_id, i < trunc((SELECT count(*) FROM images) * 0.35::DOUBLE) AS chosen FROM r", "images"
    ),
    "pick_partners": fx.with_ctes(
        """WITH p AS (SELECT image_id AS partner, row_number() OVER (ORDER BY image_id) - 1 AS i FROM images),
        d AS (SELECT image_id, nth, CAST(floor(CAST('0x' || substr(md5('0|' || image_id || '|' || nth), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE * (SELECT count(*) FROM images)) AS BIGINT) AS i
              FROM images CROSS JOIN (SELECT CAST(unnest(range(1, 4)) AS INT) AS nth))
        SELECT image_id, nth, partner FROM d JOIN p USING (i)""",
        "images",
    ),
    "pick_transform": fx.with_ctes(
        """SELECT image_id, ['rotate', 'flip', 'blur'][1 + CAST(floor(CAST('0x' || substr(md5('0|' || image_id), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE * 3) AS BIGINT)] AS transform FROM images""",
        "images",
    ),
    "route_metrics": """WITH r AS (SELECT event_id, ['val/', 'metrics/', 'train/', 'lr/'][event_id % 4 + 1] || event_type AS name, value FROM events WHERE event_id % 5 <> 0)
        SELECT event_id, name, CASE WHEN name LIKE 'val%' OR name LIKE 'metrics%' THEN 'val' ELSE 'train' END AS phase, value FROM r""",
}
