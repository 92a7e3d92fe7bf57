"""Model application in Arrow batches, and predictions as COCO annotations or evaluation rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import polygons as pg
from tessera.functions.boxes import points_to_xywh
from tessera.operators.grouping import broadcast_if_small
from tessera.operators.nms import cap_per_image, filter_confidence, top1_class
from tessera.operators.ordering import dense_id
from tessera.operators.relate import apply_labelmap
from tessera.operators.shapes import denormalise_boxes

OBJECT_LIMIT = 100  # fixed value: predictions per image that are looked at

PREDICTION = "pos int, class_idx int, score double, nx1 double, ny1 double, nx2 double, ny2 double, polygon array<array<double>>"


def batch_predict(images: DataFrame, make_model: Callable[[], Callable], key: str = "image_id", input_col: str = "content", batch_size: int = 64, schema: str = PREDICTION) -> DataFrame:
    """Ragged detections: one row per prediction of every image, and one error row per failing image.

    ``make_model()`` runs once per task and returns ``predict(list of inputs) ->
    list of row lists``.  A batch that fails, or gets fewer or more lists than images, is tried image by image, so only the
    failing image is skipped; its message is kept in ``error``.
    """
    fields = T._parse_datatype_string(schema).fieldNames()
    key_type = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()

        def rows(keys: list, inputs: list) -> list[tuple]:
            try:
                return [(k, *r, None) for k, rs in zip(keys, model(inputs), strict=True) for r in rs]
            except Exception as e:  # one bad image must not lose its batch
                if len(keys) == 1:
                    return [(keys[0], *[None] * len(fields), str(e) or type(e).__name__)]
                return [r for k, x in zip(keys, inputs) for r in rows([k], [x])]

        for pdf in batches:
            for at in range(0, len(pdf), batch_size):
                part = pdf.iloc[at : at + batch_size]
                found = rows(part[key].tolist(), part[input_col].tolist())
                yield pd.DataFrame(found, columns=[key, *fields, "error"], dtype=object)

    return images.select(key, input_col).mapInPandas(run, f"{key} {key_type}, {schema}, error string")


def embed(images: DataFrame, make_predict: Callable, input_col: str, size: int, batch_size: int = 64, tensor_shape: list[int] | None = None) -> DataFrame:
    """Column ``embedding`` from a model that maps a batch to fixed-length vectors."""
    shapes = [tensor_shape] if tensor_shape else None
    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size, input_tensor_shapes=shapes)
    return images.withColumn("embedding", udf(F.col(input_col))).filter(F.size("embedding") == size)


def linear_embedder(size: int, seed: int = 0) -> Callable:
    """A seeded random projection: the simplest model with the shape of an encoder."""

    def make():
        rng = np.random.default_rng(seed)
        weights: dict[int, np.ndarray] = {}

        def predict(batch: np.ndarray) -> np.ndarray:
            flat = batch.reshape(len(batch), -1).astype(np.float32)
            w = weights.setdefault(flat.shape[1], rng.standard_normal((flat.shape[1], size)).astype(np.float32))
            out = flat @ w
            return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

        return predict

    return make


# ---------------------------------------------------------------- pre-annotation


def _chosen(predictions: DataFrame, labelmap: DataFrame, threshold: float, shift: int, on_unknown: str, limit: int) -> DataFrame:
    """First ``limit`` predictions per image in model order, then the threshold, then the label."""
    capped = cap_per_image(predictions, limit, [F.col("pos")])
    return apply_labelmap(filter_confidence(capped, threshold), labelmap, shift, on_unknown)


def _categories_of(rows: DataFrame, categories: DataFrame, on_unknown: str) -> DataFrame:
    """Category id by label name; a label the dataset does not have is an error or drops the row."""
    names = categories.select("category_id", F.col("name").alias("label"))
    joined = rows.join(broadcast_if_small(names), "label", "left")
    if on_unknown == "drop":
        return joined.filter(F.col("category_id").isNotNull())
    missing = F.raise_error(F.concat(F.lit("label not in the dataset: "), "label")).cast("boolean")
    return joined.filter(F.when(F.col("category_id").isNotNull(), True).otherwise(missing))


def preannotate(
    predictions: DataFrame,
    images: DataFrame,
    categories: DataFrame,
    labelmap: DataFrame,
    task: str,
    threshold: float,
    shift: int = 0,
    on_unknown: str = "error",
    number: bool = True,
) -> DataFrame:
    """Predictions as COCO annotations with ids from 1 in (image, position) order.

    ``detection``: integer boxes from corners in [0, 1].  ``segmentation``: the
    polygon in integer pixels, its box and its shoelace area; empty polygons
    go.  ``classification``: the best class, as a box over the whole image.
    """
    sizes = images.select("image_id", "width", "height")
    shape = None
    if task == "classification":
        best = top1_class(predictions.select("image_id", "class_idx", "score")).withColumn("pos", F.lit(0))
        rows = apply_labelmap(filter_confidence(best, threshold), labelmap, shift, on_unknown).join(sizes, "image_id")
        whole = {"x": F.lit(0), "y": F.lit(0), "w": F.col("width"), "h": F.col("height")}
        rows = rows.withColumns(whole).withColumn("area", F.col("w").cast("double") * F.col("h")).withColumn("is_classification", F.lit(True))
        rows = rows.withColumn("segmentation", F.lit(None).cast("array<array<int>>"))
    elif task == "detection":
        rows = _chosen(predictions, labelmap, threshold, shift, on_unknown, OBJECT_LIMIT).join(sizes, "image_id")
        rows = denormalise_boxes(rows, integers=True).withColumnsRenamed({"px": "x", "py": "y", "pw": "w", "ph": "h"})
        rows = rows.withColumn("area", (F.col("w") * F.col("h")).cast("double")).withColumn("is_classification", F.lit(None).cast("boolean"))
        rows = rows.withColumn("segmentation", F.lit(None).cast("array<array<int>>"))
    elif task == "segmentation":
        rows = _chosen(predictions, labelmap, threshold, shift, on_unknown, OBJECT_LIMIT).filter(F.size("polygon") > 0)
        shape = _shape
    else:
        raise ValueError("task must be classification, detection or segmentation")
    rows = _categories_of(rows, categories, on_unknown)
    columns = ["image_id", "pos", "category_id", "x", "y", "w", "h", "score", "area", "segmentation", "is_classification"]

    def annotation(df: DataFrame) -> DataFrame:
        return (df if shape is None else shape(df)).select(*columns, F.lit(0).alias("iscrowd"))

    if shape is not None:
        rows = rows.select("image_id", "pos", "category_id", "score", "polygon")
    return dense_id(rows, ["image_id", "pos"], "ann_id", start=1, then=annotation) if number else annotation(rows)


def _shape(rows: DataFrame) -> DataFrame:
    """Polygons in integer pixels with their box and area."""
    rows = rows.withColumn("_cut", pg.truncate_points(F.col("polygon")))
    x, y, w, h = pg.enclosing_box(F.col("_cut"))
    real = F.transform("_cut", lambda p: F.transform(p, lambda v: v.cast("double")))
    rows = rows.withColumns({"x": x, "y": y, "w": w, "h": h, "area": pg.shoelace_area(real), "segmentation": F.array(pg.to_flat(F.col("_cut")))})
    return rows.withColumn("is_classification", F.lit(None).cast("boolean"))


def format_predictions(
    predictions: DataFrame, images: DataFrame, labelmap: DataFrame, task: str, threshold: float, shift: int = 0, y_first: bool = False, limit: int = OBJECT_LIMIT
) -> DataFrame:
    """Evaluation rows: shape (rectangles, polygons, classifications), the integer shape, label and score."""
    sizes = images.select("image_id", "width", "height")
    none_box = {c: F.lit(None).cast("int") for c in ("x", "y", "w", "h")}
    none_polygon = F.lit(None).cast("array<array<int>>")
    if task == "classification":
        best = top1_class(predictions.select("image_id", "class_idx", "score")).withColumn("pos", F.lit(0))
        rows = apply_labelmap(filter_confidence(best, threshold), labelmap, shift, "error")
        rows = rows.withColumns({**none_box, "polygon": none_polygon, "shape": F.lit("classifications")})
    else:
        rows = _chosen(predictions, labelmap, threshold, shift, "error", limit)
        if task == "detection":
            rows = denormalise_boxes(rows.drop("polygon").join(sizes, "image_id"), integers=True, y_first=y_first)
            rows = rows.withColumnsRenamed({"px": "x", "py": "y", "pw": "w", "ph": "h"}).withColumns({"polygon": none_polygon, "shape": F.lit("rectangles")})
        elif task == "segmentation":
            rows = rows.withColumns({**none_box, "polygon": pg.truncate_points(F.col("polygon")), "shape": F.lit("polygons")})
        else:
            raise ValueError("task must be classification, detection or segmentation")
    return rows.select("image_id", "pos", "shape", "x", "y", "w", "h", "polygon", "label", "score")


def explode_array_predictions(rows: DataFrame) -> DataFrame:
    """Rows with arrays detection_boxes (y first), detection_scores, detection_classes as one row per candidate."""
    zipped = F.arrays_zip("detection_boxes", "detection_scores", "detection_classes")
    out = rows.select("image_id", F.posexplode(zipped).alias("pos", "_p"))
    box: Column = F.col("_p.detection_boxes")
    return out.select(
        "image_id",
        "pos",
        F.col("_p.detection_classes").cast("int").alias("class_idx"),
        F.col("_p.detection_scores").alias("score"),
        *[F.get(box, i).alias(n) for i, n in enumerate(("ny1", "nx1", "ny2", "nx2"))],
    )


def flatten_ocr_results(results: DataFrame) -> DataFrame:
    """Rows (image_id, pos, x, y, w, h, text, confidence) from arrays of {points, text, confidence}; empty results give none."""
    rows = results.select("image_id", F.posexplode("result").alias("pos", "_r"))
    x, y, w, h = points_to_xywh(F.col("_r.points"))
    return rows.select(
        "image_id", "pos", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), F.col("_r.text").alias("text"), F.col("_r.confidence").alias("confidence")
    )
