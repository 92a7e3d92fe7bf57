"""Vision tables derived from the order tables: the same text runs on Spark and on DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

IMAGES = """
SELECT o_orderkey AS image_id,
       concat('img_', CAST(o_orderkey AS STRING), '.jpg') AS file_name,
       CAST(640 + 64*(o_orderkey % 8) AS INT) AS width,
       CAST(480 + 32*(o_orderkey % 5) AS INT) AS height
FROM orders
"""

ANNOTATIONS = """
SELECT (l_orderkey*100000 + l_partkey)*100000 + l_suppkey*10 + l_linenumber AS ann_id,
       l_orderkey AS image_id,
       CAST(1 + l_partkey % 5 AS INT) AS category_id,
       CAST((l_partkey*37) % 600 AS DOUBLE) AS x, CAST((l_suppkey*53) % 440 AS DOUBLE) AS y,
       CAST(16 + (l_partkey*13) % 180 AS DOUBLE) AS w, CAST(16 + (l_suppkey*29) % 150 AS DOUBLE) AS h,
       CAST(0 AS INT) AS iscrowd
FROM lineitem
"""

DETECTIONS = """
SELECT (l_orderkey*100000 + l_partkey)*100000 + l_suppkey*10 + l_linenumber AS det_id,
       l_orderkey AS image_id,
       CAST(1 + (l_partkey + CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END) % 5 AS INT) AS category_id,
       CAST((l_partkey*37) % 600 + l_suppkey % 9 - 4 AS DOUBLE) AS x,
       CAST((l_suppkey*53) % 440 + l_partkey % 7 - 3 AS DOUBLE) AS y,
       CAST(16 + (l_partkey*13) % 180 + l_suppkey % 5 AS DOUBLE) AS w,
       CAST(16 + (l_suppkey*29) % 150 AS DOUBLE) AS h,
       CAST((l_partkey*7919 + l_suppkey*104729 + l_linenumber*31) % 9973 AS DOUBLE) / 9973 AS score
FROM lineitem WHERE l_partkey % 10 <> 0
"""

CATEGORIES = """
SELECT CAST(r_regionkey + 1 AS INT) AS category_id, r_name AS name FROM region
"""

VIEWS = {
    "images": IMAGES,
    "annotations": ANNOTATIONS,
    "detections": DETECTIONS,
    "categories": CATEGORIES,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(spark: SparkSession, sf_dir: str, base: str, text: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {base}", "FROM {base}"), base=table(spark, sf_dir, base))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "orders", IMAGES)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "lineitem", ANNOTATIONS)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "lineitem", DETECTIONS)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "region", CATEGORIES)


def with_ctes(body: str, *names: str, recursive: bool = False) -> str:
    """Prefix DuckDB SQL with the derived tables it uses."""
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n].strip()})" for n in names)
    lead = "WITH RECURSIVE " if recursive else "WITH "
    body = body.strip()
    if body.split(None, 1)[0].upper() == "WITH":
        return f"{lead}{ctes},\n{body.split(None, 1)[1]}"
    return f"{lead}{ctes}\n{body}"
