"""One group holds a third or more of the rows: results against brute force, with small bounds that force the paths for large groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluate, greedy, nms, ordering, sampling, similarity
from tessera.operators.grouping import collect_parts

RNG = np.random.default_rng(3)


def boxes(n, hot, spread=300):
    image = np.where(np.arange(n) < hot, 1, RNG.integers(2, 40, n))
    return pd.DataFrame(
        {
            "det_id": np.arange(n) + 1,
            "image_id": image,
            "category_id": RNG.integers(1, 3, n).astype("int32"),
            "x": RNG.integers(0, spread, n).astype(float),
            "y": RNG.integers(0, spread, n).astype(float),
            "w": RNG.integers(10, 90, n).astype(float),
            "h": RNG.integers(10, 90, n).astype(float),
            "score": RNG.integers(0, 60, n) / 60.0,
        }
    )


def iou(a, b, px=0.0):
    iw = min(a.x + a.w, b.x + b.w) - max(a.x, b.x) + px
    ih = min(a.y + a.h, b.y + b.h) - max(a.y, b.y) + px
    inter = max(iw, 0) * max(ih, 0)
    return inter / ((a.w + px) * (a.h + px) + (b.w + px) * (b.h + px) - inter)


def brute_nms(df, t, px):
    kept = []
    for _, group in df.groupby(["image_id", "category_id"]):
        chosen = []
        for row in group.sort_values(["score", "det_id"], ascending=[False, True]).itertuples():
            if all(iou(row, k, px) <= t for k in chosen):
                chosen.append(row)
        kept += [r.det_id for r in chosen]
    return sorted(kept)


@pytest.mark.parametrize("array_rows", [4, 10_000])
def test_nms_with_a_hot_image(spark, array_rows):
    df = boxes(600, 250)
    df = pd.concat([df, df.iloc[:60].assign(det_id=lambda d: d.det_id + 10_000)])  # exact copies
    out = nms.nms_per_class(spark.createDataFrame(df), 0.3, array_rows=array_rows)
    assert sorted(r["det_id"] for r in out.select("det_id").collect()) == brute_nms(df, 0.3, 1.0)


def brute_coco(dets, truths, t, low, high, cap):
    out = set()
    for key, d in dets.groupby(["image_id", "category_id"]):
        g = [r for r in truths.itertuples() if (r.image_id, r.category_id) == key]
        ignored = {r.ann_id: bool(r.iscrowd) or r.w * r.h < low or r.w * r.h > high for r in g}
        g.sort(key=lambda r: (ignored[r.ann_id], r.ann_id))
        taken = set()
        for row in d.sort_values(["score", "det_id"], ascending=[False, True]).head(cap).itertuples():
            best, match = min(t, 1 - 1e-10), None
            for r in g:
                if r.ann_id in taken and not r.iscrowd:
                    continue
                if match is not None and not ignored[match.ann_id] and ignored[r.ann_id]:
                    break
                if r.iscrowd:
                    iw = min(row.x + row.w, r.x + r.w) - max(row.x, r.x)
                    ih = min(row.y + row.h, r.y + r.h) - max(row.y, r.y)
                    v = max(iw, 0) * max(ih, 0) / (row.w * row.h)
                else:
                    v = iou(row, r)
                if v >= best:
                    best, match = v, r
            if match is not None:
                taken.add(match.ann_id)
                out.add((row.det_id, match.ann_id, ignored[match.ann_id]))
    return out


@pytest.mark.parametrize("group_pairs", [1, 60, 500_000])
def test_coco_match_with_a_hot_image_and_crowds(spark, group_pairs):
    dets = boxes(260, 120, spread=80)
    truths = boxes(200, 90, spread=80).rename(columns={"det_id": "ann_id"}).drop(columns="score")
    truths["iscrowd"] = (RNG.random(len(truths)) < 0.1).astype("int32")
    grid = evaluate.CocoGrid(thresholds=(0.3, 0.6), areas={"all": (0.0, 1e10), "mid": (900.0, 3600.0)})
    out = evaluate.coco_match(spark.createDataFrame(dets), spark.createDataFrame(truths), grid, max_dets=40, group_pairs=group_pairs)
    rows = out.collect()
    for t in (0.3, 0.6):
        for name, (low, high) in grid.areas.items():
            got = {(r["det_id"], r["ann_id"], r["ann_ignored"]) for r in rows if r["iou_threshold"] == t and r["area_range"] == name}
            assert got == brute_coco(dets, truths, t, low, high, 40)


def test_running_values_of_a_group_over_many_slices(spark):
    n = 3000
    df = pd.DataFrame({"g": np.where(np.arange(n) % 3 > 0, 1, np.arange(n)), "o": RNG.permutation(n), "v": RNG.integers(-50, 50, n)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ordering.running(spark.createDataFrame(df), ["g"], ["o"], sums={"s": F.col("v")}, maxima={"m": F.col("v")}).toPandas()
        ids = ordering.dense_id(spark.createDataFrame(df), ["o"], "id").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = df.sort_values("o")
    want["s"], want["m"] = want.groupby("g")["v"].cumsum(), want.groupby("g")["v"].cummax()
    pd.testing.assert_frame_equal(out.sort_values("o")[["o", "s", "m"]].reset_index(drop=True), want[["o", "s", "m"]].reset_index(drop=True), check_dtype=False)
    assert (ids["id"] == ids["o"]).all()


def test_collect_parts_loses_nothing(spark):
    df = spark.createDataFrame([(1 if i < 23 else i, i, f"v{i}") for i in range(60)], "k long, o long, v string")
    rows = collect_parts(df, ["k"], ["o"], "v", "vs", limit=5).collect()
    hot = sorted((r["part"], r["vs"]) for r in rows if r["k"] == 1)
    assert [len(v) for _, v in hot] == [5, 5, 5, 5, 3]
    assert [v for _, vs in hot for v in vs] == [f"v{i}" for i in range(23)]
    assert sum(len(r["vs"]) for r in rows) == 60


def cloud():
    """A third of the vectors are near copies of one, a part of them exact."""
    base = RNG.standard_normal((240, 6))
    base[:80] = base[0] + RNG.standard_normal((80, 6)) * 0.01
    base[20:40] = base[5]
    order = RNG.permutation(240)
    return base[order].astype("float32")


def vectors(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<float>")


def test_near_pairs_against_all_pairs(spark):
    x = cloud()
    d = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(-1))
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if d[i, j] <= 1.0}
    got = {(r["first"], r["later"]) for r in similarity.near_pairs(vectors(spark, x), 1.0, block=16).collect()}
    assert got == want


def brute_novelty(x, t):
    kept = []
    for i, row in enumerate(x.astype(float)):
        if all(np.sqrt(((row - x[k].astype(float)) ** 2).sum()) > t for k in kept):
            kept.append(i)
    return kept


def test_global_novelty_with_copies(spark):
    x = cloud()
    got = sorted(r["id"] for r in similarity.novelty_global(vectors(spark, x), 1.0, block=24).collect())
    assert got == brute_novelty(x, 1.0)


@pytest.mark.parametrize("most", [1, 16])
def test_global_novelty_with_cut_lists(spark, most):
    x = cloud()
    got = sorted(r["id"] for r in similarity.novelty_global(vectors(spark, x), 1.0, block=64, most=most, slice_rows=50).collect())
    assert got == brute_novelty(x, 1.0)


def test_global_novelty_on_a_chain(spark):
    x = np.zeros((5000, 2), dtype="float32")
    x[:, 0] = np.arange(5000) * 0.6
    got = sorted(r["id"] for r in similarity.novelty_global(vectors(spark, x), 1.0).collect())
    assert got == list(range(0, 5000, 2))


def brute_settle(links):
    fate = {}
    for v in sorted(links):
        fate[v] = not any(fate[e] for e in links[v])
    return fate


@pytest.mark.parametrize("slice_rows", [40, 10_000])
def test_settle_against_the_greedy_pass(spark, slice_rows):
    n = 400
    links = {v: [v - 1] if v % 3 and v < 200 else sorted({int(e) for e in RNG.integers(0, v, 3)}) if v else [] for v in range(n)}
    links.update({v: [v - 1] for v in range(201, 300)})
    rows = spark.createDataFrame([(v, e, False) for v, e in links.items()], "id long, earlier array<bigint>, more boolean")
    got = {r["id"]: r["keep"] for r in greedy.settle(rows, "settle-test", slice_rows).collect()}
    assert got == brute_settle(links)
    cut = rows.withColumn("more", F.col("id") % 50 == 7)  # a cut list alone is never a reason to keep
    some = {r["id"]: r["keep"] for r in greedy.settle(cut, "settle-test", slice_rows).collect()}
    assert some.items() <= got.items() and 0 < len(some) < n


def test_weighted_draws_follow_the_weights(spark):
    weights = spark.createDataFrame([(1, 100.0)] + [(i, 1.0) for i in range(2, 102)] + [(200, 0.0)], "image_id long, weight double")
    rows = sampling.weighted_resample(weights, 4000).groupBy("image_id").count().collect()
    counts = {r["image_id"]: r["count"] for r in rows}
    assert sum(counts.values()) == 4000 and 200 not in counts
    assert 1850 < counts[1] < 2150


def test_split_is_exact_and_disjoint(spark):
    df = spark.range(10_007).withColumnRenamed("id", "image_id")
    out = sampling.split_dataset(df, 0.7)
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 7004, "test": 1501, "val": 1502}
    assert out.select("image_id").distinct().count() == 10_007
