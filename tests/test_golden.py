"""Known values for conversions, repartition, masks, splits and pairing."""

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.boxes import Corners, xyxy_to_xywh
from tessera.operators import pixels, relate, sampling, stats


def test_corners_to_integer_box(spark):
    box = Corners(*[F.lit(v) for v in (1176.8936, 218.8128, 1193.3655, 252.6124)])
    row = spark.range(1).select(*[c.alias(n) for n, c in zip("xywh", xyxy_to_xywh(box, truncate=True))]).first()
    assert tuple(row) == (1176, 218, 17, 34)
    scores = spark.range(1).select(F.round(F.lit(0.5396), 3), F.round(F.lit(0.5871), 3)).first()
    assert tuple(scores) == (0.54, 0.587)


def test_repartition_follows_label_order_with_zeros(spark):
    categories = spark.createDataFrame([(0, "classA"), (1, "classB"), (2, "classC")], "category_id int, name string")
    anns = spark.createDataFrame([(2,), (2,), (1,)], "category_id int")
    rows = stats.class_repartition(anns, categories).orderBy("category_id").collect()
    assert [r["n"] for r in rows] == [0, 1, 2]


def test_one_hot_of_one_class():
    mask = np.array([[1, 1, 2], [2, 3, 3]])
    assert pixels.one_hot(mask, [1]).tolist() == [[[1], [1], [0]], [[0], [0], [0]]]
    assert pixels.one_hot(mask, [1, 2]).sum(axis=-1).tolist() == [[1, 1, 1], [1, 1, 1]]


def test_nine_files_split_seven_one_one(spark):
    names = spark.createDataFrame([(f"f{i}",) for i in range(9)], "name string")
    split = sampling.split_dataset(names, 0.8, "11", "name")
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 7, "test": 1, "val": 1}


def test_image_mask_pairs_by_prefix(spark):
    images = spark.createDataFrame([("orig - DS1238.jpg",), ("orig - DS9.jpg",)], "file_name string")
    masks = spark.createDataFrame([("mask - DS1238.png",), ("mask - DS7.png",)], "mask_name string")
    rows = relate.pair_images_masks(images, masks, "orig - ", "mask - ").collect()
    assert [(r["file_name"], r["mask_name"]) for r in rows] == [("orig - DS1238.jpg", "mask - DS1238.png")]
