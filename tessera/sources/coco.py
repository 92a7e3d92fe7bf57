"""COCO documents: one JSON file to three tables and back."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.masks import polygons_of, rle_json, rle_of

_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)
_ANNOTATION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("image_id", T.LongType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("area", T.DoubleType()),
        T.StructField("segmentation", T.StringType()),  # its JSON: polygons or a run-length mask
        T.StructField("iscrowd", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("utf8_string", T.StringType()),
        T.StructField("is_classification", T.BooleanType()),
    ]
)
_CATEGORY = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("supercategory", T.StringType()),
    ]
)
DOCUMENT = T.StructType(
    [
        T.StructField("images", T.ArrayType(_IMAGE)),
        T.StructField("annotations", T.ArrayType(_ANNOTATION)),
        T.StructField("categories", T.ArrayType(_CATEGORY)),
    ]
)


class CocoTables(NamedTuple):
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


def _image_rows(df: DataFrame, row: str) -> DataFrame:
    return df.select(F.col(f"{row}.id").alias("image_id"), *[f"{row}.{c}" for c in ("file_name", "width", "height")])


def _annotation_rows(df: DataFrame, row: str) -> DataFrame:
    box = F.col(f"{row}.bbox")
    return df.select(
        F.col(f"{row}.id").alias("ann_id"),
        f"{row}.image_id",
        f"{row}.category_id",
        *[F.get(box, i).alias(n) for i, n in enumerate("xywh")],
        F.coalesce(F.col(f"{row}.area"), F.get(box, 2) * F.get(box, 3)).alias("area"),
        polygons_of(F.col(f"{row}.segmentation")).alias("segmentation"),
        rle_of(F.col(f"{row}.segmentation")).alias("rle"),
        F.coalesce(F.col(f"{row}.iscrowd"), F.lit(0)).alias("iscrowd"),
        f"{row}.score",
        F.col(f"{row}.utf8_string").alias("text"),
        f"{row}.is_classification",
    )


def _category_rows(df: DataFrame, row: str) -> DataFrame:
    return df.select(F.col(f"{row}.id").alias("category_id"), f"{row}.name", f"{row}.supercategory")


def read_coco(spark: SparkSession, path: str) -> CocoTables:
    """Tables of one or many COCO documents; a document without categories has none.

    A segmentation is read as polygons (``segmentation``) or as a run-length mask (``rle``).
    A damaged document, or a value of another type than COCO's, raises an error.
    A document is one JSON value and therefore one task: read it once and store
    the tables with ``save_tables``.  Many documents are read in parallel.
    """
    doc = spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "FAILFAST").json(path)

    def exploded(name: str) -> DataFrame:
        return doc.select(F.explode(name).alias("r"))

    return CocoTables(
        _image_rows(exploded("images"), "r"), _annotation_rows(exploded("annotations"), "r"), _category_rows(exploded("categories"), "r")
    )


def read_coco_lines(spark: SparkSession, path: str) -> CocoTables:
    """The parallel form written by ``write_coco_lines``: JSON lines, one row each, any size."""
    return CocoTables(
        _image_rows(spark.read.schema(_IMAGE).json(f"{path}/images").select(F.struct("*").alias("r")), "r"),
        _annotation_rows(spark.read.schema(_ANNOTATION).json(f"{path}/annotations").select(F.struct("*").alias("r")), "r"),
        _category_rows(spark.read.schema(_CATEGORY).json(f"{path}/categories").select(F.struct("*").alias("r")), "r"),
    )


def _image_struct():
    return F.struct(F.col("image_id").alias("id"), "file_name", "width", "height")


def _annotation_struct(df: DataFrame):
    """COCO fields of a row; a NULL score, text or flag leaves the key out."""
    has = set(df.columns)
    area = F.coalesce(F.col("area"), F.col("w") * F.col("h")) if "area" in has else F.col("w") * F.col("h")
    fields = [
        F.col("ann_id").alias("id"),
        "image_id",
        "category_id",
        F.array("x", "y", "w", "h").alias("bbox"),
        area.alias("area"),
        F.col("iscrowd") if "iscrowd" in has else F.lit(0).alias("iscrowd"),
    ]
    fields += [F.col(c) for c in ("score", "is_classification") if c in has]
    if "text" in has:
        fields.append(F.col("text").alias("utf8_string"))
    return F.struct(*fields)


def _annotation_json(df: DataFrame):
    """A row as a JSON object; its segmentation is the run-length mask, else the polygons, else an empty list."""
    forms = [rle_json(F.col("rle"))] if "rle" in df.columns else []
    forms += [F.to_json("segmentation")] if "segmentation" in df.columns else []
    fields = F.to_json(_annotation_struct(df))
    return F.concat(F.substring(fields, 1, F.length(fields) - 1), F.lit(',"segmentation":'), F.coalesce(*forms, F.lit("[]")), F.lit("}"))


def _json_rows(tables: CocoTables) -> dict[str, DataFrame]:
    category_fields = [F.col("category_id").alias("id"), "name"]
    if "supercategory" in tables.categories.columns:
        category_fields.append("supercategory")
    return {
        "images": tables.images.select("image_id", F.to_json(_image_struct()).alias("value")),
        "annotations": tables.annotations.select("ann_id", "image_id", _annotation_json(tables.annotations).alias("value")),
        "categories": tables.categories.select("category_id", F.to_json(F.struct(*category_fields)).alias("value")),
    }


def write_coco_lines(tables: CocoTables, path: str, compression: str | None = None) -> None:
    """JSON lines per table, written in parallel: the form for data of any size.

    ``compression`` is one of Spark's text writer; ``read_coco_lines`` reads such files as well.
    """
    for name, rows in _json_rows(tables).items():
        rows.select("value").write.mode("overwrite").text(f"{path}/{name}", compression=compression)


def write_coco_document(tables: CocoTables, path: str) -> None:
    """One COCO document as ordered text parts: ``cat part-*`` gives the JSON; ``info`` and ``licenses`` are empty.

    Rows are range-sorted by (table, id) and written in parallel, so no process
    holds the document.  Every table adds an opening and a closing line, and
    every row but a table's first starts with a comma.
    """
    lines = None
    spark = tables.images.sparkSession
    sections = _json_rows(tables)
    for no, (name, rows) in enumerate(sections.items()):
        key = rows.columns[0]
        first = rows.agg(F.min(key)).first()[0]
        start = ('{"info": {}, "licenses": [], ' if no == 0 else "") + f'"{name}": ['
        end = "]" + (", " if no + 1 < len(sections) else "}")
        frame = spark.range(2).select(
            F.lit(no).alias("no"),
            (F.col("id") * 2).cast("int").alias("place"),
            F.lit(0).cast("long").alias("key"),
            F.when(F.col("id") == 0, start).otherwise(end).alias("value"),
        )
        text = F.concat(F.when(F.col(key) == F.lit(first), "").otherwise(","), "value")
        body = rows.select(F.lit(no).alias("no"), F.lit(1).alias("place"), F.col(key).cast("long").alias("key"), text.alias("value"))
        part = frame.unionByName(body)
        lines = part if lines is None else lines.unionByName(part)
    order = ["no", "place", "key"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def write_coco_documents(tables: CocoTables, path: str, images_per_document: int, compression: str | None = None) -> None:
    """Complete COCO documents, each with the images of one range of ids, their annotations and all categories.

    ``read_coco`` reads them in parallel.  A document is one row of its task, so choose the
    range such that a document fits there; annotations without an image are left out.
    With a ``compression`` of Spark's text writer the files are compressed, which ``read_coco`` reads as well.
    """
    rows = _json_rows(tables)
    images = tables.images.select("image_id", F.expr(f"image_id div {int(images_per_document)}").alias("document"))
    parts = rows["images"].join(images, "image_id").select("document", F.lit(0).alias("part"), F.col("image_id").alias("id"), "value")
    placed = rows["annotations"].join(images, "image_id").select("document", F.lit(1).alias("part"), F.col("ann_id").alias("id"), "value")
    listed = F.sort_array(F.collect_list(F.struct("part", "id", "value")))
    categories = rows["categories"].agg(F.concat_ws(",", F.sort_array(F.collect_list("value"))).alias("categories"))  # one small row

    def section(part: int):
        return F.concat_ws(",", F.transform(F.filter("_rows", lambda r: r["part"] == part), lambda r: r["value"]))

    documents = parts.unionByName(placed).groupBy("document").agg(listed.alias("_rows"))
    value = F.concat(
        F.lit('{"info":{},"licenses":[],"images":['), section(0), F.lit('],"annotations":['), section(1), F.lit('],"categories":['), categories.scalar(), F.lit("]}")
    )
    documents.select("document", value.alias("value")).write.partitionBy("document").mode("overwrite").text(path, compression=compression)


def save_tables(tables: CocoTables, database: str, buckets: int = 200) -> None:
    """Store the tables; images and annotations are bucketed by image_id so their joins need no shuffle."""
    for name in ("images", "annotations"):
        df = getattr(tables, name)
        df.write.mode("overwrite").bucketBy(buckets, "image_id").sortBy("image_id").saveAsTable(f"{database}.{name}")
    tables.categories.write.mode("overwrite").saveAsTable(f"{database}.categories")
