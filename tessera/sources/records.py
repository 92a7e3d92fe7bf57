"""Per-image training records: columnar object arrays, nested examples, label text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.boxes import four_points
from tessera.functions.text import extension, stem
from tessera.operators.grouping import GROUP_ROWS, collect_parts


def _area(df: DataFrame) -> DataFrame:
    return df if "area" in df.columns else df.withColumn("area", F.col("w") * F.col("h"))


def objects_per_image(annotations: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """(image_id, part, objects) with parallel arrays id, bbox, category, area, image_id in ann_id order."""
    row = F.struct(
        F.col("ann_id").alias("id"),
        F.array("x", "y", "w", "h").alias("bbox"),
        F.col("category_id").alias("category"),
        "area",
        "image_id",
    )
    shaped = _area(annotations).select("image_id", "ann_id", row.alias("object"))
    packed = collect_parts(shaped, ["image_id"], ["ann_id"], "object", "_objects", limit)
    fields = ("id", "bbox", "category", "area", "image_id")
    columnar = F.struct(*[F.col(f"_objects.{f}").alias(f) for f in fields])
    return packed.select("image_id", "part", columnar.alias("objects"))


def metadata_records(images: DataFrame, annotations: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """One record per image (file_name, image_id, width, height, objects); images without annotations keep empty arrays."""
    objects = objects_per_image(annotations, limit)
    kind = objects.schema["objects"].dataType
    empty = F.struct(*[F.array().cast(f.dataType).alias(f.name) for f in kind.fields])
    joined = images.join(objects, "image_id", "left")
    return joined.select(
        "file_name", "image_id", "width", "height", F.coalesce("part", F.lit(0).cast("long")).alias("part"), F.coalesce("objects", empty).alias("objects")
    )


def detection_examples(annotations: DataFrame, images: DataFrame, categories: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Nested training rows: image fields, arrays xmin, xmax, ymin, ymax clipped to [0, 1], class text and id.

    With a ``segmentation`` column the polygons of each object travel along as
    the mask.
    """

    def unit(c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))

    names = categories.select("category_id", F.col("name").alias("label"))
    j = annotations.join(images.select("image_id", "width", "height"), "image_id").join(names, "category_id")
    x, y, w, h = (F.col(c) for c in "xywh")
    fields = [
        unit(x / F.col("width")).alias("xmin"),
        unit((x + w) / F.col("width")).alias("xmax"),
        unit(y / F.col("height")).alias("ymin"),
        unit((y + h) / F.col("height")).alias("ymax"),
        F.col("label").alias("class_text"),
        F.col("category_id").alias("class_id"),
    ]
    names_out = ["xmin", "xmax", "ymin", "ymax", "class_text", "class_id"]
    if "segmentation" in annotations.columns:
        fields.append(F.col("segmentation").alias("mask"))
        names_out.append("mask")
    packed = collect_parts(j.select("image_id", "ann_id", F.struct(*fields).alias("o")), ["image_id"], ["ann_id"], "o", "_o", limit)
    out = images.join(packed, "image_id")
    return out.select(
        "image_id", "part", "width", "height", "file_name", extension(F.col("file_name")).alias("format"), *[F.col(f"_o.{n}").alias(n) for n in names_out]
    )


# ---------------------------------------------------------------- label text


def number_text(v: Column) -> Column:
    """Shortest decimal text of a double; small values are written out, not as powers of ten."""
    plain = F.regexp_replace(v.cast("decimal(38,20)").cast("string"), "0+$", "")
    return F.when((F.abs(v) < 1e-3) & (v != 0), plain).otherwise(v.cast("string"))


def _class_number(df: DataFrame, class_order: list[int] | None) -> Column:
    """Class as it is, or its position in an explicit label list."""
    if class_order is None:
        return F.col("category_id")
    return F.array_position(F.array(*[F.lit(c) for c in class_order]), F.col("category_id")) - 1


def yolo_detection_lines(annotations: DataFrame, images: DataFrame, class_order: list[int] | None = None) -> DataFrame:
    """(image_id, ann_id, label_file, line) with ``class cx cy w h`` in [0, 1]."""
    j = annotations.join(images, "image_id")
    iw, ih = F.col("width"), F.col("height")
    parts = [
        (2 * F.col("x") + F.col("w")) / (2 * iw),
        (2 * F.col("y") + F.col("h")) / (2 * ih),
        F.col("w") / iw,
        F.col("h") / ih,
    ]
    line = F.concat_ws(" ", _class_number(j, class_order).cast("string"), *[number_text(p) for p in parts])
    extra = [c for c in ("split",) if c in j.columns]
    return j.select("image_id", "ann_id", *extra, F.concat(stem(F.col("file_name")), F.lit(".txt")).alias("label_file"), line.alias("line"))


def yolo_segmentation_lines(
    annotations: DataFrame, images: DataFrame, class_order: list[int] | None = None, all_polygons: bool = False
) -> DataFrame:
    """``class x1 y1 x2 y2 ...`` in [0, 1]: the first polygon of each annotation, or one line per polygon."""
    j = annotations.join(images, "image_id")
    if all_polygons:
        j = j.select("*", F.posexplode("segmentation").alias("polygon_no", "_ring"))
    else:
        j = j.withColumn("polygon_no", F.lit(0)).withColumn("_ring", F.col("segmentation")[0])
    scaled = F.transform("_ring", lambda v, i: number_text(v / F.when(i % 2 == 0, F.col("width")).otherwise(F.col("height"))))
    line = F.concat_ws(" ", _class_number(j, class_order).cast("string"), F.array_join(scaled, " "))
    extra = [c for c in ("split",) if c in j.columns]
    return j.select("image_id", "ann_id", "polygon_no", *extra, F.concat(stem(F.col("file_name")), F.lit(".txt")).alias("label_file"), line.alias("line"))


def text_blocks(lines: DataFrame, keys: list[str], order: list[str], limit: int = GROUP_ROWS) -> DataFrame:
    """(keys, part, text): the lines of a file joined by newlines; very long files come in parts."""
    packed = collect_parts(lines, keys, order, "line", "_lines", limit)
    return packed.select(*keys, "part", F.array_join("_lines", "\n").alias("text"))


def voc_result_lines(dets: DataFrame, images: DataFrame) -> DataFrame:
    """Per detection ``image conf x1 y1 x2 y2``: three and one decimals, corners counted from 1."""
    j = dets.join(images.select("image_id", "file_name"), "image_id")
    line = F.format_string(
        "%s %.3f %.1f %.1f %.1f %.1f",
        stem(F.col("file_name")),
        F.col("score"),
        F.col("x") + 1,
        F.col("y") + 1,
        F.col("x") + F.col("w") + 1,
        F.col("y") + F.col("h") + 1,
    )
    return j.select("category_id", "det_id", line.alias("line"))


def ocr_box_lines(annotations: DataFrame, images: DataFrame, categories: DataFrame, image_dir: str, limit: int = GROUP_ROWS) -> DataFrame:
    """``path TAB json`` per run of consecutive annotations: the class name as transcription and four corner points.

    ``annotations`` carries ``run`` (see ``consecutive_runs``).
    """
    names = categories.select("category_id", F.col("name").alias("transcription"))
    points = four_points(*(F.col(c) for c in "xywh"))
    row = F.struct("transcription", points.alias("points"))
    j = annotations.join(names, "category_id").select("run", "image_id", "ann_id", row.alias("row"))
    packed = collect_parts(j, ["run", "image_id"], ["ann_id"], "row", "_rows", limit)
    path = F.concat(F.lit(image_dir.rstrip("/") + "/"), F.col("file_name"))
    return packed.join(images.select("image_id", "file_name"), "image_id").select(
        "run", "part", F.concat_ws("\t", path, F.to_json("_rows")).alias("line")
    )


def ocr_text_lines(annotations: DataFrame, image_dir: str) -> DataFrame:
    """``img_<n>.png TAB text``; ``annotations`` carries the running number ``n`` and ``text``."""
    path = F.concat(F.lit(image_dir.rstrip("/") + "/img_"), F.col("n").cast("string"), F.lit(".png"))
    return annotations.select("n", F.concat_ws("\t", path, F.col("text")).alias("line"))


def class_partitions(annotations: DataFrame, images: DataFrame, categories: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Class folder of each image: its first annotation's class, and whether it had more than one annotation."""
    first = annotations.groupBy("image_id").agg(
        F.min_by("category_id", "ann_id").alias("category_id"), (F.count(F.lit(1)) > 1).alias("ambiguous")
    )
    if present is not None:
        images = images.join(present.select("file_name"), "file_name", "left_semi")
    names = categories.select("category_id", F.col("name").alias("label"))
    return images.join(first, "image_id").join(names, "category_id").select("image_id", "file_name", "label", "ambiguous")
