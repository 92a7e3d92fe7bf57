"""Registered queries: tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import copy_name, crop_name, extension, stem, tile_name, tile_origin
from tessera.operators import tiling
from tessera.sources import fixtures as fx

SPEC = tiling.TileSpec(256, 192, overlap_x=0.25, overlap_y=0.125)

# The same grid written out for the SQL side: strides 192 and 168.
_GRID = """
tiles AS (
  SELECT image_id, i AS tile_row, j AS tile_col, j*192 AS tile_x, i*168 AS tile_y,
         regexp_replace(file_name, '\\.[^.]*$', '') || '_tile_' || (j*192) || '_' || (i*168) || '.jpg' AS file_name,
         row_number() OVER (ORDER BY image_id, i, j) - 1 AS tile_id
  FROM (SELECT image_id, file_name, unnest(range(CAST(ceil(height/168.0) AS BIGINT))) AS i, width FROM images) r,
       LATERAL (SELECT unnest(range(CAST(ceil(r.width/192.0) AS BIGINT))) AS j) c
)"""

_MET = """
met AS (
  SELECT a.ann_id, a.image_id, a.category_id, a.w AS ow, a.h AS oh, t.tile_id, t.tile_x, t.tile_y,
         greatest(a.x, t.tile_x) - t.tile_x AS x, greatest(a.y, t.tile_y) - t.tile_y AS y,
         least(a.x + a.w, t.tile_x + 256) - greatest(a.x, t.tile_x) AS w,
         least(a.y + a.h, t.tile_y + 192) - greatest(a.y, t.tile_y) AS h
  FROM annotations a JOIN tiles t ON a.image_id = t.image_id
   AND a.x < t.tile_x + 256 AND a.x + a.w > t.tile_x AND a.y < t.tile_y + 192 AND a.y + a.h > t.tile_y
)"""


def tile_grid(spark, sf):
    grid = tiling.tile_grid(tiling.with_first_tile_id(fx.images(spark, sf), SPEC), SPEC)
    return grid.select("image_id", "tile_id", "tile_row", "tile_col", "tile_x", "tile_y", "width", "height", "file_name")


def tile_grid_drop(spark, sf):
    spec = tiling.TileSpec(256, 192, mode="drop")
    return tiling.tile_grid(fx.images(spark, sf), spec).select("image_id", "tile_x", "tile_y")


def tile_overlap_join(spark, sf):
    met = tiling.tile_overlap_join(fx.annotations(spark, sf), fx.images(spark, sf), SPEC)
    return met.select("ann_id", "image_id", "tile_x", "tile_y", "cut_x", "cut_y", "cut_w", "cut_h")


def tile_annotations(spark, sf):
    out = tiling.tile_annotations(fx.annotations(spark, sf), fx.images(spark, sf), SPEC, 12, 12, 0.2)
    return out.select("ann_id", "source_ann_id", "tile_id", "category_id", "x", "y", "w", "h", "area")


def tile_labels(spark, sf):
    out = tiling.tile_labels(fx.annotations(spark, sf), fx.images(spark, sf), SPEC, counted=True)
    return out.select("tile_id", "file_name", "category_id", "n")


OCTAGON = (
    "array(array(x + w*0.25, y, x + w*0.75, y, x + w, y + h*0.25, x + w, y + h*0.75, "
    "x + w*0.75, y + h, x + w*0.25, y + h, x, y + h*0.75, x, y + h*0.25))"
)


def with_octagons(annotations):
    """Annotations with an octagon on the sides of their box as polygon."""
    return annotations.withColumn("segmentation", F.expr(OCTAGON))


def tile_polygons(spark, sf):
    from tessera.functions.polygons import shoelace_area, to_points

    out = tiling.tile_polygons(with_octagons(fx.annotations(spark, sf)), fx.images(spark, sf), SPEC, 12, 12, 0.2)
    ring = F.col("segmentation")[0]
    return out.select(
        "ann_id", "source_ann_id", "tile_id", (F.size(ring) / 2).cast("int").alias("points"), F.round(shoelace_area(to_points(ring)), 4).alias("area")
    )


def derive_filenames(spark, sf):
    tiles = tiling.tile_grid(fx.images(spark, sf), SPEC).select(F.col("file_name").alias("tile_name"), "image_id")
    x, y = tile_origin(F.col("tile_name"))
    return tiles.select(
        "image_id",
        "tile_name",
        x.alias("tile_x"),
        y.alias("tile_y"),
        stem(F.col("tile_name")).alias("stem_last"),
        stem(F.col("tile_name"), "first_dot").alias("stem_first"),
        stem(F.col("tile_name"), "last_four").alias("stem_four"),
        extension(F.col("tile_name")).alias("ext"),
        copy_name(F.col("tile_name"), F.lit(2)).alias("copy_suffix"),
        copy_name(F.col("tile_name"), F.lit(2), "prefix").alias("copy_prefix"),
        crop_name(F.col("image_id"), F.lit("cat"), x, y, F.lit(10), F.lit(12), F.col("tile_name")).alias("crop"),
    )


QUERIES = {
    "tile_grid": tile_grid,
    "tile_grid_drop": tile_grid_drop,
    "tile_overlap_join": tile_overlap_join,
    "tile_annotations": tile_annotations,
    "tile_labels": tile_labels,
    "clip_polygons_to_tile": tile_polygons,
    "derive_filenames": derive_filenames,
}

SQL = {
    "tile_grid": fx.with_ctes(
        f"WITH {_GRID} SELECT image_id, tile_id, tile_row, tile_col, tile_x, tile_y, 256 AS width, 192 AS height, file_name FROM tiles",
        "images",
    ),
    "tile_grid_drop": fx.with_ctes(
        """
        SELECT image_id, i*256 AS tile_x, j*192 AS tile_y
        FROM (SELECT image_id, height, unnest(range(CAST(width//256 AS BIGINT))) AS i FROM images) r,
             LATERAL (SELECT unnest(range(CAST(r.height//192 AS BIGINT))) AS j) c
        """,
        "images",
    ),
    "tile_overlap_join": fx.with_ctes(
        f"WITH {_GRID}, {_MET} SELECT ann_id, image_id, tile_x, tile_y, x AS cut_x, y AS cut_y, w AS cut_w, h AS cut_h FROM met",
        "images",
        "annotations",
    ),
    "tile_annotations": fx.with_ctes(
        f"""WITH {_GRID}, {_MET}
        SELECT row_number() OVER (ORDER BY tile_id, ann_id) - 1 AS ann_id, ann_id AS source_ann_id, tile_id, category_id,
               x, y, w, h, w*h AS area
        FROM met WHERE NOT (w < ow AND w < 12) AND NOT (h < oh AND h < 12) AND w*h/(ow*oh) >= 0.2""",
        "images",
        "annotations",
    ),
    "tile_labels": fx.with_ctes(
        f"""WITH {_GRID}
        SELECT tile_id, file_name, category_id, count(*) AS n
        FROM annotations JOIN tiles USING (image_id) GROUP BY ALL""",
        "images",
        "annotations",
    ),
    # Sutherland-Hodgman side by side: signed area of a clipped convex ring from its corner lists.
    "derive_filenames": fx.with_ctes(
        f"""WITH {_GRID}
        SELECT image_id, file_name AS tile_name, tile_x, tile_y, split_part(file_name, '.', 1) AS stem_last,
               split_part(file_name, '.', 1) AS stem_first, left(file_name, length(file_name) - 4) AS stem_four, 'jpg' AS ext,
               split_part(file_name, '.', 1) || '_2.jpg' AS copy_suffix, 'augmented-2-' || file_name AS copy_prefix,
               image_id || '_cat_' || tile_x || '_' || tile_y || '_10_12.jpg' AS crop
        FROM tiles""",
        "images",
    ),
}
