"""Joins between images, annotations, categories, masks and labels, and label-set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import name_ratio
from tessera.operators.grouping import bounded_rows, broadcast_if_small
from tessera.operators.ordering import dense_id

# Grey levels of class masks.
MAX_GREY = 255
MAX_MASK_CLASSES = 24


# ---------------------------------------------------------------- joins


def enrich_annotations(
    annotations: DataFrame, images: DataFrame, categories: DataFrame, only_label: str | None = None
) -> DataFrame:
    """Annotation rows with file name, image size and category name."""
    if only_label is not None:
        categories = categories.filter(F.col("name") == only_label)
    names = categories.select("category_id", F.col("name").alias("label"))
    frames = images.select("image_id", "file_name", "width", "height")
    return annotations.join(broadcast_if_small(names), "category_id").join(frames, "image_id")


def _missing(df: DataFrame, found: Column, key: str, on_missing: str, what: str) -> DataFrame:
    if on_missing == "null":
        return df
    if on_missing == "drop":
        return df.filter(found)
    if on_missing == "error":
        message = F.concat(F.lit(f"{what} not found: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        return df.filter(F.when(found, True).otherwise(F.raise_error(message).cast("boolean")))
    raise ValueError(f"on_missing must be error, null or drop, not {on_missing!r}")


def lookup_by_filename(names: DataFrame, images: DataFrame, on_missing: str = "error") -> DataFrame:
    """Image id for every file name."""
    ids = images.select("file_name", "image_id")
    joined = names.join(ids, "file_name", "left")
    return _missing(joined, F.col("image_id").isNotNull(), "file_name", on_missing, "image")


def pair_images_masks(images: DataFrame, masks: DataFrame, image_prefix: str, mask_prefix: str) -> DataFrame:
    """First mask (by name) whose stem equals the image's stem once both prefixes are cut off."""

    def core(name: str, prefix: str) -> Column:
        first = F.substring_index(name, ".", 1)
        return F.substring(first, len(prefix) + 1, F.length(first))

    first_mask = masks.groupBy(core("mask_name", mask_prefix).alias("_core")).agg(F.min("mask_name").alias("mask_name"))
    paired = images.withColumn("_core", core("file_name", image_prefix)).join(first_mask, "_core").drop("_core")
    rest = F.substring(F.col("mask_name"), len(mask_prefix.strip()) + 1, F.length("mask_name"))
    return paired.withColumn("new_mask_name", F.concat(F.lit(image_prefix.strip()), rest))


def pair_labels_masks(labels: DataFrame, masks: DataFrame) -> DataFrame:
    """Label line i of an image with mask i: ``labels`` has (image_key, line_no), masks are named ``<key>_<i>.<ext>``.

    The number in the mask name is the position; label lines without a mask drop out.
    """
    keyed = masks.select(
        F.substring_index("mask_name", "_", 1).alias("image_key"),
        F.regexp_extract("mask_name", r"_(\d+)\.", 1).try_cast("long").alias("line_no"),
        "mask_name",
    )
    return labels.join(keyed, ["image_key", "line_no"])


def anti_join_annotated(images: DataFrame, annotations: DataFrame) -> DataFrame:
    return images.join(annotations.select("image_id"), "image_id", "left_anti")


def semi_join_present(images: DataFrame, present: DataFrame, on: str = "image_id") -> DataFrame:
    return images.join(present.select(on), on, "left_semi")


def pixel_classes(categories: DataFrame, exact: bool = False) -> DataFrame:
    """(value, category_id, label) for every grey value that belongs to a class.

    Class values are equally spaced in label order; the margin is a third of
    the smallest gap (0 with ``exact``).  At most 256 rows.
    """
    n = len(bounded_rows(categories, "mask classes", MAX_MASK_CLASSES))
    step = MAX_GREY // n
    margin = 0 if exact or n < 2 else step // 3
    nth = F.row_number().over(Window.orderBy("category_id"))  # bounded: at most 24 classes
    centred = categories.withColumn("_c", (nth * step).cast("int"))
    values = F.sequence(F.col("_c") - margin, F.least(F.col("_c") + margin, F.lit(MAX_GREY)))
    return centred.select(F.explode(values).alias("value"), "category_id", F.col("name").alias("label"))


def class_of_pixel(pixels: DataFrame, categories: DataFrame, exact: bool = False) -> DataFrame:
    """Class of each pixel or pixel run by its grey ``value``; other values drop out."""
    return pixels.join(F.broadcast(pixel_classes(categories, exact)), "value")


def fuzzy_label_match(names: DataFrame, labels: DataFrame) -> DataFrame:
    """Most similar label for every distinct ``name`` (NULL when nothing is similar), with its ratio.

    The label list is small by nature and is checked; it travels as one array
    literal, so there is no product join.
    """
    listed = [r["label"] for r in bounded_rows(labels.select("label_pos", "label").orderBy("label_pos"), "labels")]
    scored = F.transform(
        F.array(*[F.struct(F.lit(-i).alias("p"), F.lit(text).alias("label")) for i, text in enumerate(listed)]),
        lambda s: F.struct(name_ratio(F.col("name"), s["label"]).alias("ratio"), s["p"].alias("p"), s["label"].alias("label")),
    )
    best = names.select("name").distinct().withColumn("_best", F.array_max(scored))
    return best.select(
        "name",
        F.when(F.col("_best.ratio") > 0, F.col("_best.label")).alias("label"),
        F.col("_best.ratio").alias("ratio"),
    )


def label_id_ignoring_case(names: DataFrame, labels: DataFrame) -> DataFrame:
    """Id of the first label equal to ``name`` apart from case, -1 when there is none."""
    lowered = labels.groupBy(F.lower("label").alias("_key")).agg(F.min_by("label_id", "label_pos").alias("label_id"))
    joined = names.withColumn("_key", F.lower("name")).join(broadcast_if_small(lowered), "_key", "left").drop("_key")
    return joined.withColumn("label_id", F.coalesce("label_id", F.lit(-1)))


def labelmap_shift(labelmap: DataFrame) -> int:
    """1 when the map starts at key 0 (detectors of the TF family count from 1), else 0."""
    return 1 if not labelmap.filter(F.col("class_idx") == 0).isEmpty() else 0


def apply_labelmap(predictions: DataFrame, labelmap: DataFrame, shift: int = 0, on_unknown: str = "error") -> DataFrame:
    """Label text for ``class_idx``; ``shift`` is subtracted before the lookup."""
    shifted = predictions.withColumn("_idx", F.col("class_idx") - shift)
    names = labelmap.select(F.col("class_idx").alias("_idx"), "label")
    joined = shifted.join(broadcast_if_small(names), "_idx", "left").drop("_idx")
    return _missing(joined, F.col("label").isNotNull(), "class_idx", on_unknown, "label of class")


# ---------------------------------------------------------------- label sets


def label_overlap(model: DataFrame, dataset: DataFrame) -> DataFrame:
    """Each label with the side that has it: common, dataset_only or model_only."""
    m = model.select("label").distinct().withColumn("_m", F.lit(True))
    d = dataset.select("label").distinct().withColumn("_d", F.lit(True))
    side = (
        F.when(F.col("_m") & F.col("_d"), "common")
        .when(F.col("_d"), "dataset_only")
        .otherwise("model_only")
    )
    return m.join(d, "label", "full").select("label", side.alias("side"))


def require_label_overlap(model: DataFrame, dataset: DataFrame) -> None:
    if model.select("label").intersect(dataset.select("label")).isEmpty():
        raise ValueError("model and dataset have no label in common")


def labels_equal(model: DataFrame, dataset: DataFrame) -> bool:
    m, d = model.select("label"), dataset.select("label")
    return m.subtract(d).union(d.subtract(m)).isEmpty()


def require_labels_equal(model: DataFrame, dataset: DataFrame) -> None:
    if not labels_equal(model, dataset):
        raise ValueError("model and dataset labels differ: add the missing labels or use the add strategy")


def add_missing_labels(dataset: DataFrame, model: DataFrame) -> DataFrame:
    """Dataset labels plus the model's missing ones with the next free ids, in model order."""
    known = dataset.select("label_id", "label")
    new = (
        model.join(known.select("label"), "label", "left_anti")
        .groupBy("label")
        .agg(F.min("label_pos").alias("label_pos"))
    )
    last = known.agg(F.coalesce(F.max("label_id"), F.lit(0))).first()[0]
    added = dense_id(new, ["label_pos", "label"], "label_id", start=last + 1)
    return known.unionByName(added.select(F.col("label_id").cast(known.schema["label_id"].dataType), "label"))


def union_datasets(first: DataFrame, second: DataFrame, sources: tuple[str, str], order: list[str], id_col: str) -> DataFrame:
    """Rows of both datasets with a ``source`` column and new consecutive ids, first dataset first."""
    both = (
        first.withColumn("source_pos", F.lit(0)).withColumn("source", F.lit(sources[0]))
        .unionByName(
            second.withColumn("source_pos", F.lit(1)).withColumn("source", F.lit(sources[1])),
            allowMissingColumns=True,
        )
        .withColumnRenamed(id_col, f"source_{id_col}")
    )
    keys = [f"source_{c}" if c == id_col else c for c in order]
    return dense_id(both, ["source_pos", *keys], id_col, start=1).drop("source_pos")
