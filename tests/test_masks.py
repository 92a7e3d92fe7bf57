"""Run-length masks: the codec against plain loops, and mask evaluation against cases worked out by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.masks import RLE, pack_counts
from tessera.operators import evaluate, masks, overlap
from tessera.sources import coco

KEYS = ["image_id", "ann_id"]


def counts_of(mask):
    flat = mask.T.reshape(-1)
    out, value = [], 0
    at = 0
    while at < len(flat):
        end = at
        while end < len(flat) and flat[end] == value:
            end += 1
        out.append(end - at)
        at, value = end, 1 - value
    return out


def text_of(counts):
    out = ""
    for i, c in enumerate(counts):
        x = c - counts[i - 2] if i > 2 else c
        while True:
            bits, x = x & 31, x >> 5
            last = x == (-1 if bits & 16 else 0)
            out += chr(48 + bits + (0 if last else 32))
            if last:
                break
    return out


def cases():
    rng = np.random.default_rng(7)
    made = [np.zeros((5, 4), int), np.ones((5, 4), int), np.eye(6, dtype=int), np.zeros((300, 1000), int)]
    made[3][17:290, 2:998] = 1
    made += [(rng.random((int(rng.integers(1, 40)), int(rng.integers(1, 40)))) < p).astype(int) for p in (0.02, 0.3, 0.5, 0.9, 0.98)]
    return made


def rows(spark, packed):
    data = []
    for i, m in enumerate(cases()):
        counts = counts_of(m)
        data.append((1, i, (m.shape[0], m.shape[1], None if packed else counts, text_of(counts) if packed else None)))
    data.append((1, 99, None))
    return spark.createDataFrame(data, f"image_id long, ann_id long, rle {RLE}")


def test_counts_are_packed_as_the_plain_loop_does(spark):
    got = {r["ann_id"]: r["t"] for r in rows(spark, False).where("rle IS NOT NULL").select("ann_id", pack_counts(F.col("rle.counts")).alias("t")).collect()}
    assert got == {i: text_of(counts_of(m)) for i, m in enumerate(cases())}


@pytest.mark.parametrize("packed", [False, True])
def test_runs_are_the_pixels_and_give_the_counts_again(spark, packed):
    runs = masks.rle_runs(rows(spark, packed), KEYS)
    drawn = {i: np.zeros_like(m) for i, m in enumerate(cases())}
    for r in runs.collect():
        piece = drawn[r["ann_id"]][r["start"] : r["end"], r["row"]]
        assert piece.size == r["end"] - r["start"] > 0 and not piece.any()
        piece[:] = 1
    assert all((drawn[i] == m).all() for i, m in enumerate(cases()))
    sizes = spark.createDataFrame([(1, i, *m.shape) for i, m in enumerate(cases())], "image_id long, ann_id long, height int, width int")
    back = {r["ann_id"]: r["rle"]["counts"] for r in masks.runs_to_rle(runs, sizes, KEYS).collect()}
    assert back == {i: counts_of(m) for i, m in enumerate(cases())}


def test_empty_table_and_overlapping_runs(spark):
    none = rows(spark, True).where("false")
    assert masks.rle_runs(none, KEYS).count() == 0
    runs = spark.createDataFrame([(1, 0, 4), (1, 2, 6), (1, 6, 7), (1, 9, 10), (1, 3, 3), (2, 3, 5), (2, 3, 5)], "k int, start int, end int")
    assert sorted(map(tuple, masks.merged_runs(runs, ["k"]).collect())) == [(1, 0, 7), (1, 9, 10), (2, 3, 5)]


def test_run_rows_of_a_mask_are_few_parts_and_may_repeat_or_overlap(spark):
    solid = [(1, r, 5, 90) for r in range(200)]
    odd = [(2, 7, 0, 4), (2, 3, 2, 6), (2, 3, 2, 6), (2, 5, 2, 6), (2, 7, 3, 9), (2, 64, 0, 10), (2, 65, 0, 10), (2, 3, 8, 8)]
    runs = spark.createDataFrame([(1, *r) for r in odd[::-1] + solid], "image_id long, ann_id long, row int, start int, end int")
    assert {r["ann_id"]: r["n"] for r in masks._gathered(runs.where("ann_id = 1"), KEYS).select("ann_id", F.size("_parts").alias("n")).collect()} == {1: 4}
    sizes = spark.createDataFrame([(1, 1, 100, 200), (1, 2, 10, 70), (1, 3, 10, 70)], "image_id long, ann_id long, height int, width int")
    made = {1: np.zeros((100, 200), int), 2: np.zeros((10, 70), int), 3: np.zeros((10, 70), int)}
    for ann, row, start, end in solid + odd:
        made[ann][start:end, row] = 1
    got = {r["ann_id"]: r["rle"]["counts"] for r in masks.runs_to_rle(runs, sizes, KEYS).collect()}
    assert got == {k: counts_of(m) for k, m in made.items()}


def test_plain_and_packed_masks_of_one_table_and_a_text_that_breaks_off(spark):
    data = [(1, i, (*m.shape, counts_of(m) if i % 2 else None, None if i % 2 else text_of(counts_of(m)))) for i, m in enumerate(cases())]
    data += [(2, 1, (5, 5, None, "")), (2, 2, (5, 5, None, text_of([3, 4, 18]) + "P")), (2, 3, (5, 5, None, None)), (2, 4, (5, 5, None, text_of([3, 4, 18])))]
    df = spark.createDataFrame(data, f"image_id long, ann_id long, rle {RLE}").coalesce(1)
    want = {(1, i): counts_of(m) for i, m in enumerate(cases())} | {(2, 1): [], (2, 2): [3, 4, 18], (2, 4): [3, 4, 18]}
    assert {(r["image_id"], r["ann_id"]): r["counts"] for r in masks.count_arrays(df, KEYS).collect()} == want
    assert {(r["image_id"], r["ann_id"]): r["n"] for r in masks.run_areas(masks.rle_runs(df, KEYS), KEYS).withColumnRenamed("area", "n").collect()} == {
        k: sum(v[1::2]) for k, v in want.items() if sum(v[1::2])
    }


def test_compressed_documents_are_read_again(spark, tmp_path):
    images = spark.createDataFrame([(i, f"{i}.jpg", 5, 4) for i in range(30)], "image_id long, file_name string, width int, height int")
    boxes = images.select("image_id", F.col("image_id").alias("ann_id"), F.lit(1).alias("category_id"), *[F.lit(1.0).alias(c) for c in "xywh"])
    tables = coco.CocoTables(images, boxes, spark.createDataFrame([(1, "cat")], "category_id int, name string"))
    coco.write_coco_documents(tables, str(tmp_path / "d"), 10, compression="gzip")
    files = list((tmp_path / "d").rglob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".gz") for f in files)
    back = coco.read_coco(spark, str(tmp_path / "d"))
    assert back.annotations.count() == back.images.count() == 30 and back.categories.count() == 3


def test_polygon_and_packed_masks_survive_a_document(spark, tmp_path):
    square = {"size": [4, 5], "counts": [0, 2, 2, 2, 14]}
    doc = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 5, "height": 4}],
        "categories": [{"id": 1, "name": "cat"}],
        "annotations": [
            {"id": 1, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "iscrowd": 1, "segmentation": square},
            {"id": 2, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "iscrowd": 1, "segmentation": {"size": [4, 5], "counts": text_of(square["counts"])}},
            {"id": 3, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 3], "area": 5, "segmentation": [[0, 0, 2, 0, 2, 3, 0, 3], [0, 0, 2, 0, 2, 2, 0, 2]]},
            {"id": 4, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 3], "segmentation": []},
        ],
    }
    (tmp_path / "a.json").write_text(json.dumps(doc))
    tables = coco.read_coco(spark, str(tmp_path / "a.json"))
    coco.write_coco_documents(tables, str(tmp_path / "again"), 10)
    for t in (tables, coco.read_coco(spark, str(tmp_path / "again"))):
        areas = masks.run_areas(masks.annotation_runs(t.annotations), KEYS)
        assert {r["ann_id"]: r["area"] for r in areas.collect()} == {1: 4, 2: 4, 3: 6}
        assert {r["ann_id"]: r["area"] for r in t.annotations.collect()} == {1: 4.0, 2: 4.0, 3: 5.0, 4: 6.0}
    coco.write_coco_lines(tables, str(tmp_path / "lines"))
    again = coco.read_coco_lines(spark, str(tmp_path / "lines")).annotations
    assert again.where("rle IS NOT NULL").count() == 2 and again.where("size(segmentation) = 2").count() == 1


def test_damaged_document_raises(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"images": [{"id": 1, "file_name"')
    with pytest.raises(Exception):
        coco.read_coco(spark, str(tmp_path / "bad.json")).images.collect()


def test_mask_evaluation_counts_pixels_and_own_areas(spark):
    def run_rows(cells, key):
        return spark.createDataFrame([(1, i, row, 0, end) for i, row, end in cells], f"image_id long, {key} long, row int, start int, end int")

    boxes = "image_id long, category_id int, x double, y double, w double, h double"
    truths = spark.createDataFrame([(1, 1, 0.0, 0.0, 40.0, 40.0, 1, 0, 800.0), (1, 1, 50.0, 0.0, 40.0, 40.0, 2, 1, 1600.0)], boxes + ", ann_id long, iscrowd int, area double")
    dets = spark.createDataFrame([(1, 1, 0.0, 0.0, 40.0, 40.0, 1, 0.9), (1, 1, 50.0, 0.0, 10.0, 40.0, 2, 0.8), (1, 1, 0.0, 0.0, 40.0, 40.0, 3, 0.7)], boxes + ", det_id long, score double")
    truth_runs = run_rows([(1, r, 20) for r in range(40)] + [(2, r, 40) for r in range(50, 90)], "ann_id")
    det_runs = run_rows([(1, r, 20) for r in range(30)] + [(2, r, 40) for r in range(50, 60)] + [(3, r, 40) for r in range(40)], "det_id")
    pairs = overlap.mask_iou_join(det_runs.withColumnRenamed("det_id", "mask_id"), truth_runs.withColumnRenamed("ann_id", "mask_id"))
    assert {(r["a_mask"], r["b_mask"]): r["iou"] for r in pairs.collect()} == {(1, 1): 0.75, (2, 2): 0.25, (3, 1): 0.5}
    grid = evaluate.CocoGrid(thresholds=(0.5, 0.75, 0.8))
    runs = evaluate.MaskRuns(det_runs, truth_runs)
    got = {tuple(r) for r in evaluate.coco_match(dets, truths, grid, masks=runs).where("area_range IN ('all', 'medium')").collect()}
    crowd = {(t, a, 2, 2, True) for t in grid.thresholds for a in ("all", "medium")}
    own = {(t, a, 1, 1, a == "medium") for t in (0.5, 0.75) for a in ("all", "medium")}  # its own area of 800 is small
    assert got == crowd | own
    small = evaluate.coco_class_metrics(dets, truths, grid, masks=runs).where("area_range = 'small' AND max_dets = 100").collect()
    assert {r["iou_threshold"]: r["ar"] for r in small} == {0.5: 1.0, 0.75: 1.0, 0.8: 0.0}


def test_curves_of_many_classes_and_of_classes_without_truths(spark):
    n = 3000  # each class is a small group of its own
    box = [F.lit(float(v)).alias(c) for c, v in zip("xywh", (0, 0, 50, 50))]
    one = spark.range(n).select(F.col("id").alias("image_id"), F.col("id").cast("int").alias("category_id"), F.col("id").alias("ann_id"), F.lit(0).alias("iscrowd"), *box)
    dets = spark.range(n + 5).select(F.col("id").alias("image_id"), F.col("id").cast("int").alias("category_id"), F.col("id").alias("det_id"), F.lit(0.5).alias("score"), *box)
    metrics = evaluate.coco_class_metrics(dets, one, evaluate.CocoGrid(thresholds=(0.5,)))
    got = metrics.where("area_range = 'all' AND max_dets = 100").agg(F.count("ap").alias("n"), F.avg("ap").alias("ap"), F.avg("ar").alias("ar")).first()
    assert (got["n"], round(got["ap"], 9), got["ar"]) == (n, 1.0, 1.0)
