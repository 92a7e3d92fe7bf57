"""Crowded images and pixel rows: the same rows as brute force, and no task with most of the work."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import overlap, sampling, sweep

RNG = np.random.default_rng(11)


def boxes(n, low, high, image=1, first=0, spread=1.0):
    x, y = RNG.random(n) * spread, RNG.random(n) * spread
    w, h = RNG.uniform(low, high, n), RNG.uniform(low, high, n)
    return [(image, first + i, *map(float, b)) for i, b in enumerate(zip(x, y, w, h))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "image_id int, id long, x double, y double, w double, h double")


def brute(left, right, pixel):
    out = set()
    for i, a, x, y, w, h in left:
        for j, b, p, q, r, s in right:
            if i == j and min(x + w, p + r) + pixel > max(x, p) and min(y + h, q + s) + pixel > max(y, q):
                out.add((a, b))
    return out


@pytest.mark.parametrize("pixel", [0.0, 1.0])
def test_tree_of_cells_equals_brute_force(spark, pixel):
    scale = 300.0 if pixel else 1.0
    rows = boxes(300, 0.001, 0.03) + boxes(40, 0.2, 0.9, first=1000) + boxes(30, 0.0, 0.0, first=2000) + boxes(20, 0.1, 0.3, image=2, first=3000)
    rows += [(1, 4000 + i, 0.5, 0.5, 0.01, 0.01) for i in range(60)] + [(3, 5000, 0.1, 0.1, 0.2, 0.2)]
    rows = [(i, d, *(v * scale for v in b)) for i, d, *b in rows]
    left, right = rows[::2], rows[1::2] + rows[:40:2]
    pairs = overlap.overlap_pairs(frame(spark, left), frame(spark, right), ["image_id"], pixel, load=20, block=15)
    got = [(r["a_id"], r["b_id"]) for r in pairs.select("a_id", "b_id").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(left, right, pixel)


def test_boxes_on_one_spot_and_on_one_line(spark):
    spot = [(1, i, 5.0, 5.0, 1.0, 1.0) for i in range(50)]
    line = [(2, i, float(i), 0.0, 1.5, 1.0) for i in range(80)]
    rows = spot + line
    pairs = overlap.overlap_pairs(frame(spark, rows), frame(spark, rows), ["image_id"], load=10, block=7)
    got = sorted((r["image_id"], r["a_id"], r["b_id"]) for r in pairs.select("image_id", "a_id", "b_id").collect())
    assert got == sorted([(1, a, b) for a in range(50) for b in range(50)] + [(2, a, b) for a in range(80) for b in range(80) if abs(a - b) < 1.5])


def test_normalised_boxes_of_one_image_are_spread(spark):
    rows = boxes(50_000, 0.001, 0.004)
    df = frame(spark, rows)
    split = overlap._crowded(df, df, ["image_id"], overlap.LOAD)
    depth = split.where("split").agg(F.max("level")).first()[0] + 1
    leaves = overlap._descend(overlap._prefixed(df, ["image_id"], "a_"), "a_", ["image_id"], split, depth, 0.0)
    loads = leaves.groupBy("_level", "_cx", "_cy").count()
    assert loads.agg(F.max("count")).first()[0] <= overlap.LOAD
    placed = leaves.repartition(8, "image_id", "_level", "_cx", "_cy").groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    assert len(placed) == 8 and placed.max() <= 2 * placed.median()


def runs(n, rows, width):
    out = []
    for i in range(n):
        start = int(RNG.integers(0, width - 1))
        out.append((1, i % 40, int(RNG.integers(0, rows)), start, int(min(width, start + RNG.integers(1, width // 3)))))
    return out


@pytest.mark.parametrize("crowded", [5, 10_000])
def test_sweep_of_a_crowded_row(spark, monkeypatch, crowded):
    monkeypatch.setattr(sweep.cut_rows, "__defaults__", (crowded, 16))
    monkeypatch.setattr(sweep.sweep_rows, "__defaults__", (crowded, 16))
    rows = [(1, a, r, s, e) for a, r, s, e in {(a, r, s, e) for _, a, r, s, e in runs(150, 3, 120)}]
    df = spark.createDataFrame([(i, a, (a * 7) % 40, r, s, e) for i, a, r, s, e in rows], "image_id int, ann_id long, rank int, row int, start int, end int")
    wanted = {}
    for _, a, r, s, e in rows:
        for c in range(s, e):
            wanted[r, c] = max(wanted.get((r, c), (-1, -1)), ((a * 7) % 40, a))
    got = {}
    for r in sampling.top_instance(df).collect():
        for c in range(r["start"], r["end"]):
            assert (r["row"], c) not in got
            got[r["row"], c] = r["ann_id"]
    assert got == {k: v[1] for k, v in wanted.items()}


def test_mask_iou_of_a_crowded_row(spark, monkeypatch):
    monkeypatch.setattr(sweep.cut_rows, "__defaults__", (5, 16))
    masks = {}
    for _, a, r, s, e in runs(120, 3, 120):
        masks.setdefault(a, set()).update((r, c) for c in range(s, e))
    pixels = [(1, a, r, c, c + 1) for a, held in masks.items() for r, c in held]  # a run per pixel
    df = spark.createDataFrame(pixels, "image_id int, mask_id long, row int, start int, end int")
    left, right = df.where("mask_id % 2 = 0"), df.where("mask_id % 2 = 1")
    got = {(r["a_mask"], r["b_mask"]): r["iou"] for r in overlap.mask_iou_join(left, right).collect()}
    wanted = {(a, b): len(masks[a] & masks[b]) / len(masks[a] | masks[b]) for a in masks for b in masks if a % 2 == 0 and b % 2 == 1 and masks[a] & masks[b]}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-12 for k in wanted)
