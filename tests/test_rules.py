"""Hand cases for the rules that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import polygons as pg
from tessera.functions import text
from tessera.operators import evaluate, nms, predict, relate, shapes, stats, tiling
from tessera.sources import records

ANN = "ann_id long, image_id long, category_id int, x double, y double, w double, h double"


def images(spark, *rows):
    return spark.createDataFrame(list(rows), "image_id long, file_name string, width int, height int")


def test_tile_grid_and_drop_mode(spark):
    one = images(spark, (1, "a.b.jpg", 250, 100))
    grid = tiling.tile_grid(one, tiling.TileSpec(100, 100, overlap_x=0.5)).orderBy("tile_x").collect()
    assert [r["tile_x"] for r in grid] == [0, 50, 100, 150, 200]
    assert grid[1]["file_name"] == "a.b_tile_50_0.jpg"
    whole = tiling.tile_grid(one, tiling.TileSpec(100, 100, overlap_x=0.5, mode="drop")).collect()
    assert sorted(r["tile_x"] for r in whole) == [0, 50, 100, 150]
    assert tiling.tile_grid(one, tiling.TileSpec(100, 120, mode="drop")).count() == 0


def test_minimum_side_counts_only_where_the_box_was_cut(spark):
    one = images(spark, (1, "a.jpg", 200, 100))
    anns = spark.createDataFrame([(1, 1, 1, 95.0, 10.0, 10.0, 4.0), (2, 1, 1, 10.0, 10.0, 3.0, 3.0)], ANN)
    kept = tiling.tile_annotations(anns, one, tiling.TileSpec(100, 100), min_width=6).collect()
    # box 1 is cut to 5 wide on both sides and goes; box 2 is small but whole
    assert [r["source_ann_id"] for r in kept] == [2]
    both = tiling.tile_annotations(anns, one, tiling.TileSpec(100, 100), min_area_ratio=0.5).orderBy("ann_id").collect()
    assert [(r["source_ann_id"], r["x"], r["w"], r["ann_id"]) for r in both] == [(1, 95.0, 5.0, 0), (2, 10.0, 3.0, 1), (1, 0.0, 5.0, 2)]


def test_polygon_clip_matches_area_by_hand(spark):
    def clip(flat, w, h):
        ring = pg.clip_points(pg.to_points(F.array(*[F.lit(float(v)) for v in flat])), F.lit(0.0), F.lit(0.0), F.lit(float(w)), F.lit(float(h)))
        return spark.range(1).select(pg.shoelace_area(ring), F.size(ring)).first()

    assert clip([-5, -5, 5, -5, 5, 5, -5, 5], 10, 10) == (25.0, 4)
    assert clip([2, 2, 4, 2, 4, 4, 2, 4], 10, 10) == (4.0, 4)
    assert clip([20, 20, 30, 20, 30, 30], 10, 10)[1] == 0
    assert clip([5, -5, 15, 5, 5, 15, -5, 5], 10, 10)[0] == 100.0  # a diamond whose sides pass through the corners


def test_clipped_polygons_cover_the_whole_polygon(spark):
    """Tiles without overlap share a polygon among them; pieces stay inside their tile."""
    one = images(spark, (1, "a.jpg", 300, 300))
    ring = [110.0, 40.0, 250.0, 90.0, 280.0, 220.0, 130.0, 260.0, 40.0, 150.0]
    anns = spark.createDataFrame([(1, 1, 1, 40.0, 40.0, 240.0, 220.0)], ANN).withColumn("segmentation", F.array(F.array(*[F.lit(v) for v in ring])))
    tiles = tiling.tile_polygons(anns, one, tiling.TileSpec(100, 100))
    points = pg.to_points(F.col("segmentation")[0])
    rows = tiles.select("ann_id", pg.shoelace_area(points).alias("area"), F.array_max(F.col("segmentation")[0]).alias("far")).collect()
    whole = spark.range(1).select(pg.shoelace_area(pg.to_points(F.array(*[F.lit(v) for v in ring])))).first()[0]
    assert len(rows) == 9 and sorted(r["ann_id"] for r in rows) == list(range(9))
    assert sum(r["area"] for r in rows) == pytest.approx(whole) and max(r["far"] for r in rows) <= 100.0


def test_metric_lines(spark):
    line = "[2024] trainer INFO: epoch: [3/100], global_step: 20, lr: 0.001, acc: 1, note: slow, bare"
    rows = spark.range(1).select(F.explode(text.metric_pairs(F.lit(line))).alias("p")).select("p.*")
    got = {r["key"]: (r["k"], r["v"]) for r in rows.select("key", text.metric_kind(F.col("key"), F.col("text")).alias("k"), text.metric_number(F.col("key"), F.col("text")).alias("v")).collect()}
    assert got == {"epoch": ("int", 3.0), "global_step": ("int", 20.0), "lr": ("float", 0.001), "acc": ("int", 1.0), "note": ("string", None)}


def test_small_numbers_are_written_out(spark):
    row = spark.range(1).select(records.number_text(F.lit(0.00025)), records.number_text(F.lit(0.5)), records.number_text(F.lit(0.0))).first()
    assert tuple(row) == ("0.00025", "0.5", "0.0")


def test_letterbox_keeps_all_boxes_when_all_would_vanish(spark):
    frames = images(spark, (1, "a.jpg", 1000, 1000), (2, "b.jpg", 1000, 1000))
    anns = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 5.0, 5.0), (2, 2, 1, 0.0, 0.0, 5.0, 5.0), (3, 2, 1, 0.0, 0.0, 500.0, 500.0)], ANN)
    out = shapes.letterbox_boxes(anns, frames, 100, 100)
    assert sorted(r["ann_id"] for r in out.collect()) == [1, 3]


def test_unknown_names_follow_the_policy(spark):
    frames = images(spark, (1, "a.jpg", 10, 10))
    names = spark.createDataFrame([("a.jpg",), ("b.jpg",)], "file_name string")
    assert relate.lookup_by_filename(names, frames, "null").count() == 2
    assert relate.lookup_by_filename(names, frames, "drop").count() == 1
    with pytest.raises(Exception, match="image not found: b.jpg"):
        relate.lookup_by_filename(names, frames, "error").collect()


def test_label_sets(spark):
    a = spark.createDataFrame([("x", 0), ("y", 1)], "label string, label_pos int")
    b = spark.createDataFrame([("y", 5), ("z", 6)], "label string, label_id int")
    assert not relate.labels_equal(a, b)
    with pytest.raises(ValueError):
        relate.require_labels_equal(a, b)
    relate.require_label_overlap(a, b)
    assert sorted(tuple(r) for r in relate.add_missing_labels(b.select("label_id", "label"), a).collect()) == [(5, "y"), (6, "z"), (7, "x")]


def test_voc_strict_threshold_and_difficult(spark):
    truth = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 9.0, 9.0, False), (2, 2, 1, 0.0, 0.0, 9.0, 9.0, True)], ANN + ", difficult boolean")
    dets = spark.createDataFrame(
        [(1, 1, 1, 0.0, 0.0, 9.0, 9.0, 0.5), (2, 1, 1, 0.0, 0.0, 9.0, 9.0, 0.9), (3, 2, 1, 0.0, 0.0, 9.0, 9.0, 0.9), (4, 1, 1, 0.0, 0.0, 4.0, 9.0, 0.95)],
        "det_id long, image_id long, category_id int, x double, y double, w double, h double, score double",
    )
    got = {r["det_id"]: r["outcome"] for r in evaluate.voc_match(dets, truth, 0.5).collect()}
    assert got == {2: "tp", 1: "fp", 3: "ignored", 4: "fp"}  # 4: (5 * 10) / 100 is not above 0.5


def test_average_precision_without_truth_or_detections(spark):
    none = spark.createDataFrame([], "category_id int, det_id long, score double, is_tp long, tp long, fp long, recall double, precision double, npos long")
    positives = spark.createDataFrame([(1, 0), (2, 5)], "category_id int, npos long")
    assert {r["category_id"]: r["ap"] for r in evaluate.average_precision(none, positives, "coco").collect()} == {1: -1.0, 2: 0.0}
    assert {r["ap"] for r in evaluate.average_precision(none, positives, "area").collect()} == {0.0}


@pytest.mark.parametrize("array_rows", [1, 512])
@pytest.mark.parametrize(("threshold", "pixel", "want"), [(1.0, 1.0, [1, 2, 3, 4, 5]), (0.5, 0.0, [1, 3, 4, 5]), (0.5, 1.0, [1, 3, 4])])
def test_equal_and_empty_boxes_in_groups_of_any_size(spark, array_rows, threshold, pixel, want):
    rows = [(1, 1, 1, 0.0, 0.0, 9.0, 9.0, 0.9), (2, 1, 1, 0.0, 0.0, 9.0, 9.0, 0.8), (3, 1, 1, 20.0, 20.0, 9.0, 9.0, 0.7)]
    rows += [(4, 1, 1, 3.0, 3.0, 0.0, 0.0, 0.6), (5, 1, 1, 3.0, 3.0, 0.0, 0.0, 0.5)]
    dets = spark.createDataFrame(rows, "det_id long, image_id long, category_id int, x double, y double, w double, h double, score double")
    out = nms.nms_per_class(dets, threshold, pixel=pixel, array_rows=array_rows)
    assert sorted(r["det_id"] for r in out.collect()) == want


def test_top1_tie_takes_the_lower_class(spark):
    rows = spark.createDataFrame([(1, 3, 0.5), (1, 2, 0.5), (1, 4, 0.1)], "image_id long, class_idx int, score double")
    assert nms.top1_class(rows).first()["class_idx"] == 2


def test_preannotate_refuses_or_drops_unknown_labels(spark):
    frames = images(spark, (1, "a.jpg", 100, 100))
    preds = spark.createDataFrame([(1, 0, 0, 0.9, 0.1, 0.1, 0.5, 0.5), (1, 1, 7, 0.9, 0.1, 0.1, 0.5, 0.5)], "image_id long, pos int, class_idx int, score double, nx1 double, ny1 double, nx2 double, ny2 double")
    cats = spark.createDataFrame([(1, "cat")], "category_id int, name string")
    labelmap = spark.createDataFrame([(0, "cat")], "class_idx int, label string")
    with pytest.raises(Exception, match="label of class not found"):
        predict.preannotate(preds, frames, cats, labelmap, "detection", 0.5)
    out = predict.preannotate(preds, frames, cats, labelmap, "detection", 0.5, on_unknown="drop").collect()
    assert [(r["ann_id"], r["x"], r["w"], r["area"]) for r in out] == [(1, 10, 40, 1600.0)]


def test_validation_counts(spark):
    frames = images(spark, (1, "a.jpg", 10, 10))
    cats = spark.createDataFrame([(1, "cat")], "category_id int, name string")
    anns = spark.createDataFrame([(1, 1, 1, -1.0, 0.0, 5.0, 5.0), (1, 2, 9, 0.0, 0.0, 5.0, 5.0)], ANN).withColumn("segmentation", F.array(F.array(F.lit(1.0), F.lit(2.0))))
    got = {r["rule"]: r["n"] for r in stats.validate_coco(frames, anns, cats, label="dog").collect()}
    assert got == {
        "invalid_box": 1, "invalid_polygon": 2, "unknown_image": 1, "unknown_category": 1, "class_beyond_count": 1,
        "duplicate_annotation_id": 1, "duplicate_image_id": 0, "too_few_images": 1, "label_absent": 1,
    }


def test_repair_cuts_boxes_and_drops_the_rest(spark):
    frames = images(spark, (1, "a.jpg", 10, 10))
    cats = spark.createDataFrame([(1, "cat")], "category_id int, name string")
    anns = spark.createDataFrame(
        [(1, 1, 1, -1.0, 0.0, 5.0, 5.0), (2, 2, 1, 0.0, 0.0, 5.0, 5.0), (3, 1, 9, 0.0, 0.0, 5.0, 5.0), (4, 1, 1, 8.0, 8.0, 5.0, 5.0), (5, 1, 1, 9.5, 0.0, 5.0, 5.0)], ANN
    )
    out = {r["ann_id"]: (r["x"], r["w"]) for r in stats.repair_coco(frames, anns, cats).collect()}
    assert out == {1: (0.0, 5.0), 4: (8.0, 2.0)}
