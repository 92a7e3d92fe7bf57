"""Readers and writers of label files, result files and image folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import stem
from tessera.sources.records import text_blocks

# Image file extensions that are listed, in both cases.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tiff")


# ---------------------------------------------------------------- YOLO


def write_yolo_labels(lines: DataFrame, path: str) -> None:
    """Label lines partitioned by split, one row per label file: (label_file, part, text) as Parquet.

    A file per image would mean as many files as images; a row per label file
    keeps the content and the name.
    """
    keys = [c for c in ("split",) if c in lines.columns] + ["label_file"]
    order = [c for c in ("ann_id", "polygon_no") if c in lines.columns]
    blocks = text_blocks(lines, keys, order)
    writer = blocks.write.mode("overwrite")
    if "split" in keys:
        writer = writer.partitionBy("split")
    writer.parquet(path)


def write_line_files(lines: DataFrame, path: str, partition_by: str) -> None:
    """Plain text lines in folders by a column with few values, such as split or class."""
    lines.select(partition_by, F.col("line").alias("value")).write.mode("overwrite").partitionBy(partition_by).text(path)


def parse_yolo_line(line: Column) -> dict[str, Column]:
    """Columns of ``class x1 y1 x2 y2 conf``."""
    parts = F.split(F.trim(line), r"\s+")
    out = {"class_id": F.get(parts, 0).try_cast("int")}
    for i, n in enumerate(("x1", "y1", "x2", "y2", "confidence"), start=1):
        out[n] = F.get(parts, i).try_cast("double")
    return out


def read_yolo_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label lines of all files below ``path`` with the image key from the file name."""
    raw = spark.read.option("recursiveFileLookup", True).text(path).select("value", "_metadata.file_name")
    rows = raw.filter(F.trim("value") != "")
    return rows.select(stem(F.col("file_name"), "first_dot").alias("image_key"), *[c.alias(n) for n, c in parse_yolo_line(F.col("value")).items()])


# ---------------------------------------------------------------- VOC

_OBJECT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("pose", T.StringType()),
        T.StructField("truncated", T.IntegerType()),
        T.StructField("difficult", T.IntegerType()),
        T.StructField("bndbox", T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])),
    ]
)
VOC_DOCUMENT = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("size", T.StructType([T.StructField(c, T.IntegerType()) for c in ("width", "height", "depth")])),
        T.StructField("object", T.ArrayType(_OBJECT)),
    ]
)


def read_voc_xml(spark: SparkSession, path: str, training: bool = False, keep_difficult: bool = True) -> DataFrame:
    """Objects of VOC annotation files: name, pose, truncated, difficult, integer corners.

    ``training`` counts corners from 0 (one is subtracted); without
    ``keep_difficult`` difficult objects are left out.
    """
    docs = spark.read.format("xml").option("rowTag", "annotation").schema(VOC_DOCUMENT).load(path)
    rows = docs.select("filename", "size.width", "size.height", F.explode("object").alias("o"))
    shift = 1 if training else 0
    corners = [(F.col(f"o.bndbox.{c}").cast("int") - shift).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    out = rows.select(
        "filename",
        "width",
        "height",
        F.trim("o.name").alias("name"),
        "o.pose",
        "o.truncated",
        (F.coalesce("o.difficult", F.lit(0)) == 1).alias("difficult"),
        *corners,
    )
    return out if keep_difficult else out.filter(~F.col("difficult"))


def parse_voc_result(line: Column) -> dict[str, Column]:
    parts = F.split(F.trim(line), " ")
    out = {"image_key": F.get(parts, 0)}
    for i, n in enumerate(("score", "x1", "y1", "x2", "y2"), start=1):
        out[n] = F.get(parts, i).try_cast("double")
    return out


def read_voc_results(spark: SparkSession, path: str) -> DataFrame:
    """Result lines with the class from the partition folder."""
    raw = spark.read.text(path)
    parsed = [c.alias(n) for n, c in parse_voc_result(F.col("value")).items()]
    return raw.select(*[c for c in raw.columns if c != "value"], *parsed)


# ---------------------------------------------------------------- images, metrics


def scan_images(spark: SparkSession, path: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, content: bool = False) -> DataFrame:
    """Image files below ``path`` by extension; ``content`` adds the bytes."""
    every = ",".join([*extensions, *[e.upper() for e in extensions]])
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{every}}}").load(path)
    )
    columns = [F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length"]
    return files.select(*columns, *(["content"] if content else []))


def read_metric_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Training result CSV with padded cells; columns by position, NULL for text that is no number."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    )
    return raw.select(*[F.col(c).try_cast("double").alias(c) for c in columns])


def metric_csv_rows(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ready for the result CSV: text becomes a number, 0.0 where it is none."""
    return metrics.select(*[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in columns])


def write_metric_csv(metrics: DataFrame, columns: list[str], path: str) -> None:
    metric_csv_rows(metrics, columns).write.mode("overwrite").option("header", True).csv(path)
