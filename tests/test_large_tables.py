"""Plans and forms that larger tables need."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import polygons as pg
from tessera.functions.masks import pack_counts
from tessera.operators import augment, evaluate, masks, nms, overlap, pixels, sampling, similarity, tiling
from tessera.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tile_labels_broadcast_no_tiles(spark):
    out = tiling.tile_labels(fx.annotations(spark, SF), fx.images(spark, SF), tiling.TileSpec(256, 192))
    joined = [line for line in plan(out).splitlines() if "Join" in line and "image_id" in line]
    assert joined and not any("Broadcast" in line for line in joined)


def test_tile_label_counts_are_those_of_the_rows_and_move_no_tiles(spark):
    spec = tiling.TileSpec(256, 192, overlap_x=0.25)
    images = spark.createDataFrame([(1, "a.jpg", 700, 500), (2, "b.jpg", 200, 100), (2, "b.jpg", 200, 100), (3, "c.jpg", 300, 300), (None, "d.jpg", 300, 300)], "image_id long, file_name string, width int, height int")
    labels = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 2, 5), (1, 3, None), (2, 4, 6), (None, 5, 5), (9, 6, 5)], "image_id long, ann_id long, category_id int")
    rows = tiling.tile_labels(labels, images, spec).groupBy("tile_id", "file_name", "category_id").agg(F.count(F.lit(1)).alias("n"))
    counts = tiling.tile_labels(labels, images, spec, counted=True)
    assert sorted(map(str, counts.select(*rows.columns).collect())) == sorted(map(str, rows.collect())) != []
    lines = plan(counts).splitlines()
    above = lines[: next(i for i, line in enumerate(lines) if "Join" in line and "image_id" in line)]
    assert any("Generate" in line for line in above) and not any("Exchange" in line for line in above)  # nothing is moved after the join


def test_made_pixels_are_not_broadcast(spark):
    rows = [(i, 2 + i % 2, 3, 1, bytes(range(i, i + 3 * (2 + i % 2)))) for i in range(6)]
    images = spark.createDataFrame(rows, "image_id long, height int, width int, nChannels int, data binary").coalesce(1)
    boxes = images.selectExpr("image_id", "image_id * 10 as ann_id", "1d as x", "1d as y", "3d as w", "2d as h")
    crops = pixels.crop_pixels(images, boxes)
    assert "BroadcastHashJoin" not in plan(crops)
    got = {r["ann_id"]: bytes(r["data"]) for r in crops.collect()}
    for i, height, _, _, data in rows:
        a = np.zeros((height + 2, 6), np.uint8)
        a[:height, :3] = np.frombuffer(data, np.uint8).reshape(height, 3)
        assert got[i * 10] == a[1:3, 1:4].tobytes()
    copies = images.withColumn("copy_no", F.lit(0))
    assert "BroadcastHashJoin" not in plan(pixels.warp_pixels(images, pixels.warp_parameters(copies)))


@pytest.mark.parametrize("grid", [False, True])
def test_runs_of_many_rings(grid):
    rng = np.random.default_rng(5)
    for n in range(3, 9):
        rings = rng.integers(-10, 30, (20, n, 2)) / 2 if grid else rng.uniform(-20, 60, (20, n, 2))
        place, *runs = pixels._ring_runs(rings)
        for i, ring in enumerate(rings):
            wanted = sorted(zip(*(v.tolist() for v in pixels.polygon_runs(ring))))
            assert sorted(zip(*(v[place == i].tolist() for v in runs))) == wanted


def test_masks_travel_as_arrays(spark):
    """Counts are packed and unpacked without a row per count."""
    rng = np.random.default_rng(3)
    listed = [[int(v) for v in rng.integers(0, 1 << int(rng.integers(1, 40)), n)] for n in (0, 1, 2, 3, 4, 9, 200)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(listed)], "ann_id long, counts array<bigint>")
    packed = df.select("ann_id", F.struct(F.lit(10).alias("height"), F.lit(10).alias("width"), F.lit(None).cast("array<bigint>").alias("counts"), pack_counts(F.col("counts")).alias("packed")).alias("rle"))
    back = masks.count_arrays(packed, ["ann_id"])
    assert "Window" not in plan(back) and "Explode" not in plan(back)
    assert {r["ann_id"]: r["counts"] for r in back.collect()} == dict(enumerate(listed))


def test_curves_of_a_class_are_counted_in_bounded_groups(spark, monkeypatch):
    """One class in one slice: a group holds a chunk of it, and the chunks add up."""
    n = 500
    score = F.pmod(F.xxhash64("id"), F.lit(97)) / 97
    flags = spark.range(n).select(
        F.lit(1).alias("category_id"), F.col("id").alias("det_id"), score.alias("score"), (F.col("id") % 40 + 1).cast("int").alias("det_rank"),
        (F.xxhash64("id").bitwiseAND(3)).alias("tp"), F.bitwise_not(F.xxhash64("id")).bitwiseAND(3).alias("fp"),
    ).coalesce(1)
    grid = evaluate.CocoGrid(thresholds=(0.5,), areas={"all": (0.0, 1e10), "small": (0.0, 1024.0)})
    positives = spark.createDataFrame([(1, "all", n), (1, "small", n // 2)], "category_id int, area_range string, npos long")
    whole = sorted(evaluate._coco_buckets(flags, positives, grid).collect())
    monkeypatch.setattr(evaluate, "CURVE_ROWS", 16)
    cut = evaluate._coco_buckets(flags, positives, grid)
    assert whole and sorted(cut.collect()) == whole
    assert "chunk" in plan(cut)


def test_rings_are_clipped_together_as_one_by_one(spark):
    rng = np.random.default_rng(8)
    rings = [[[float(v) for v in rng.integers(-4, 15, n) * 10] for n in rng.choice([0, 1, 4, 6, 7, 16], k)] for k in (0, 1, 2, 3) * 20]
    rows = [(i, 1, r, 1.0, 1.0) for i, r in enumerate(rings)] + [(99, 1, None, 1.0, 1.0), (98, 1, [None, [10.0, 10.0, 60.0, 10.0, 60.0, 120.0]], 1.0, 1.0)]
    anns = spark.createDataFrame(rows, "ann_id long, image_id long, segmentation array<array<double>>, w double, h double")
    images = spark.createDataFrame([(1, 101, 91)], "image_id long, width int, height int")
    cut = augment.clip_polygons_to_image(anns, images)
    assert "lambdafunction" not in plan(cut)
    one = pg.clip_points(pg.to_points(F.col("r")), F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(90.0))
    alone = anns.select("ann_id", F.posexplode("segmentation").alias("pos", "r")).select("ann_id", "pos", one.alias("ring")).where("size(ring) >= 3")
    wanted = {}
    for r in alone.orderBy("ann_id", "pos").collect():
        wanted.setdefault(r["ann_id"], []).append([v for p in r["ring"] for v in p])
    assert wanted and {r["ann_id"]: r["segmentation"] for r in cut.collect()} == wanted


def test_dense_blocks_are_compared_in_bounded_memory():
    """Vectors that are all near each other: the pairs' differences are never held all at once."""
    rng = np.random.default_rng(2)
    a = rng.random((1200, 64)) / 100
    b = a[:700] + 1e-3
    tracemalloc.start()
    i, j, d = similarity._matches(a, b, 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 1200 * 700 and peak < 150e6
    some = rng.integers(0, len(i), 500)
    assert np.array_equal(d[some], np.sqrt(((a[i[some]] - b[j[some]]) ** 2).sum(1)))


def test_equal_pixel_rows_of_a_mask_are_one_band(spark):
    """Boxes and a ragged mask over several strips against plain sets of pixels; boxes are few rows before any shuffle."""
    rng = np.random.default_rng(6)
    rows, pixels_of = [], {}
    for mask in range(14):
        x, y, w, h = (int(v) for v in rng.integers(1, 130, 4))
        for r in range(y - 40, y - 40 + h):
            end = x + w + (r % 3 if mask % 7 == 0 else 0)
            rows.append((1, mask, r, x, end))
            pixels_of.setdefault(mask, set()).update((r, c) for c in range(x, end))
    df = spark.createDataFrame(rows, "image_id long, mask_id long, row int, start int, end int").coalesce(1)
    left, right = df.where("mask_id < 8"), df.where("mask_id >= 6")
    assert overlap._bands(right.where("mask_id != 7")).count() < 20
    got = {(r["a_mask"], r["b_mask"]): (r["common"], r["a_area"], r["b_area"]) for r in overlap.mask_overlaps(left, right).collect()}
    wanted = {(a, b): (len(p & q), len(p), len(q)) for a, p in pixels_of.items() if a < 8 for b, q in pixels_of.items() if b >= 6 and p & q}
    assert wanted and got == wanted
    given = overlap.mask_overlaps(left, overlap._bands(right))
    assert {(r["a_mask"], r["b_mask"]): (r["common"], r["a_area"], r["b_area"]) for r in given.collect()} == wanted


@pytest.mark.parametrize("laid", [1, 40, 1 << 21])
def test_rows_are_swept_in_lots(monkeypatch, laid):
    """All rows of a lot in one call; pieces touch no pixel twice and show the top run, by pieces or by the heap."""
    monkeypatch.setattr(sampling, "LAID", laid)
    rng = np.random.default_rng(9)
    group = np.sort(rng.integers(0, 12, 90))
    group = np.unique(group, return_inverse=True)[1]
    start = rng.integers(-5, 40, 90)
    end, rank, ann = start + rng.integers(1, 15, 90), rng.integers(0, 6, 90), rng.permutation(90)
    wanted = {}
    for i in np.lexsort((ann, end, -rank))[::-1]:
        wanted.update({(int(group[i]), c): int(i) for c in range(start[i], end[i])})
    got = {}
    for i, s, e in zip(*(v.tolist() for v in sampling._top_of_rows(group, start, end, rank, ann))):
        for c in range(s, e):
            assert (int(group[i]), c) not in got
            got[int(group[i]), c] = i
    assert got == wanted


def test_matching_moves_and_compiles_little(spark, monkeypatch):
    """Crowds are found by keys alone, contested pairs without a shuffle, and combinations by threshold and by area."""
    staged = {}

    def watch(module):
        write = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name: staged.setdefault(name, plan(df)) and write(df, name))

    watch(overlap)
    watch(evaluate)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(evaluate.coco_match(fx.detections(spark, SF), fx.annotations(spark, SF)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Window" not in staged["full"] and "score" not in staged["full"]
    assert "contested" in staged["coco-pairs"] and staged["coco-pairs"].count("Exchange hashpartitioning") == 2
    assert text.count("CASE WHEN") < 100  # one per combination and branch would be 160


def test_equal_boxes_are_told_by_their_area(spark):
    """The short test whether a box suppresses its equal gives what the IoU gives, also for odd sides."""
    inf, nan = float("inf"), float("nan")
    sides = [-3.0, -1.0, 0.0, 1e-200, 0.5, 7.0, 1e200, inf, nan, None]
    rows = [(x, 2.0, w, h) for x in (1.5, -4.0, nan, None) for w in sides for h in sides]
    boxes = spark.createDataFrame(rows, "x double, y double, w double, h double")
    own = nms.corners()
    tests = [(t, p) for t in (-0.5, 0.0, 0.1, 1.0, 2.0) for p in (0.0, 1.0)]
    pairs = [(nms._self_clash(t, p), F.coalesce(nms.iou(own, own, p) > t, F.lit(False))) for t, p in tests]
    assert not any(boxes.agg(*[F.count_if(a != b).alias(f"d{i}") for i, (a, b) in enumerate(pairs)]).first())


def test_rounds_of_suppression_are_short_code(spark):
    detections = fx.detections(spark, SF)
    free = detections.filter(~nms._self_clash(0.1, 1.0))
    assert free._jdf.queryExecution().optimizedPlan().toString().count("l_partkey") < 30


def test_a_computed_ring_is_computed_once(spark):
    """The ring's expression stands once in the plan of its points, not once per use."""
    ring = F.array(*[(F.col("id") * i).cast("double") for i in range(1, 9)])
    points = spark.range(2).select(pg.to_points(ring).alias("p"))
    assert points._jdf.queryExecution().optimizedPlan().toString().count("* 8)") == 1
    assert points.collect()[1]["p"] == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]]
    none = F.lit(None).cast("array<double>")
    assert spark.range(1).select(pg.to_points(none), pg.to_points(F.array(F.lit(1.0)))).first()[:] == ([], [])


def test_first_claims_are_found_where_the_pairs_lie(spark):
    """Detections and truths are moved for the join, then detections and claims for the result; nothing else."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        truths = fx.annotations(spark, SF).withColumn("difficult", F.col("ann_id") % 7 == 0)
        texts = [plan(evaluate.voc_match(fx.detections(spark, SF), truths)), plan(evaluate.voc_flags(fx.detections(spark, SF), truths, (0.5, 0.75)))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [t.count("Exchange hashpartitioning") for t in texts] == [4, 4]


def test_round_trip_writes_compressed_lines_and_joins_no_polygons(spark, monkeypatch, tmp_path):
    from tessera.plans import files

    monkeypatch.setattr(files, "stage_path", lambda spark, name: str(tmp_path / name))
    out = files.coco_round_trip(spark, SF)
    written = list((tmp_path / "coco-lines").rglob("part-*"))
    assert written and all(f.name.endswith(".gz") for f in written)
    lines = plan(out).splitlines()
    first = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("size(" in line for line in lines[first:]) and not any("size(" in line for line in lines[:first])
    assert out.where("numbers <> 16").count() == 0 and out.count() == fx.detections(spark, SF).count()
