"""Registered queries: pixels, log lines, streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import pixels, relate, sampling
from tessera.operators.augment import affine_boxes, expand_augmentations
from tessera.operators.tiling import TileSpec
from tessera.plans.augmentation import _box_model, _labelmap
from tessera.plans.tiling import with_octagons
from tessera.session import stage_path
from tessera.sources import fixtures as fx
from tessera.streaming import metrics, tables

TAG = "INFO:"


def _log_lines(spark, sf):
    """Two log lines per event, the second one later in the same epoch; one run per event type."""
    e = fx.table(spark, sf, "events")
    line = F.concat(
        F.lit("trainer INFO: epoch: ["), F.col("event_id") % 50, F.lit("/50], global_step: "), F.col("event_id"),
        F.lit(", loss: "), F.col("value").cast("string"), F.lit(", best: "), F.when(F.col("event_id") % 3 == 0, F.lit("none")).otherwise(F.col("event_id").cast("string")),
    )
    return e.select("event_id", F.col("event_type").alias("run"), line.alias("line"))


def parse_metric_lines(spark, sf):
    out = metrics.parse_metric_lines(_log_lines(spark, sf).select("event_id", "line"), TAG)
    return out.select("event_id", "key", "text", "kind", "value")


def stream_metrics(spark, sf):
    """The lines as a text stream: each (run, epoch) reported once."""
    path = stage_path(spark, "logs")
    _log_lines(spark, sf).repartition("run").select("run", F.col("line").alias("value")).write.partitionBy("run").text(path)
    raw = spark.readStream.schema("value string, run string").text(path)
    stream = metrics.stream_metrics(raw.select("run", F.col("value").alias("line")), TAG)
    return metrics.run_to_table(stream, stage_path(spark, "metric-rows"), stage_path(spark, "metric-state"))


def _event_values(df):
    """Values cut to quarters, so sums are exact in any order."""
    return df.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"), (F.floor(F.col("value") * 4) / 4).alias("value"))


def meters_tumbling(spark, sf):
    return metrics.windowed_meters(_event_values(fx.table(spark, sf, "events")), "ts", "name", "value", "6 hours")


def meters_sliding(spark, sf):
    return metrics.windowed_meters(_event_values(fx.table(spark, sf, "events")), "ts", "name", "value", "6 hours", slide="2 hours")


def meters_session(spark, sf):
    return metrics.windowed_meters(_event_values(fx.table(spark, sf, "events")), "ts", "name", "value", "", gap="20 minutes")


def stream_meters(spark, sf):
    """The tumbling meters on a stream: windows that the watermark has closed."""
    events = fx.table(spark, sf, "events")
    source = spark.readStream.schema(events.schema).parquet(f"{sf}/event[s].parquet")
    stream = metrics.windowed_meters(_event_values(source), "ts", "name", "value", "6 hours", late_by="1 hour")
    return metrics.run_to_table(stream, stage_path(spark, "meters"), stage_path(spark, "meters-state"))


def stream_novelty(spark, sf):
    base = fx.table(spark, sf, "embeddings")
    source = spark.readStream.schema(base.schema).parquet(f"{sf}/embedding[s].parquet")
    vectors = source.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    out = stage_path(spark, "kept")
    tables.stream_novelty(vectors, 1.2, out, stage_path(spark, "kept-state")).awaitTermination()
    return spark.read.parquet(out).select("id")


def stream_preannotate(spark, sf):
    """Documents arrive as model input; the annotated ones are skipped."""
    base = fx.table(spark, sf, "documents")
    source = spark.readStream.schema(base.schema).parquet(f"{sf}/document[s].parquet")
    arriving = source.select(F.col("doc_id").alias("image_id"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.col("text").alias("content"))
    out = stage_path(spark, "annotated")

    def annotated():
        return fx.table(spark, sf, "documents").filter("doc_id % 10 = 0").select(F.col("doc_id").alias("image_id"))

    query = tables.stream_preannotate(
        arriving, annotated, _box_model, fx.categories(spark, sf), _labelmap(spark, sf), "detection", 0.3, out, stage_path(spark, "annotated-state")
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("image_id", "category_id", "x", "y", "w", "h", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- pixels


def _pictures(spark, sf):
    """A small picture per image, 24 x 16 with three channels; a byte is (7 * row + 13 * column + 29 * channel + id) mod 251."""
    r, c, k = np.mgrid[0:16, 0:24, 0:3]
    base = 7 * r + 13 * c + 29 * k

    def draw(batches):
        for pdf in batches:
            data = [((base + i) % 251).astype(np.uint8).tobytes() for i in pdf["image_id"]]
            yield pdf.assign(height=16, width=24, nChannels=3, data=data)

    # a small file is one task; its ids become many times as many bytes
    ids = fx.images(spark, sf).select("image_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ids.mapInPandas(draw, "image_id long, height int, width int, nChannels int, data binary")


@F.pandas_udf(T.LongType())
def _total(data: pd.Series) -> pd.Series:
    ends = np.cumsum(data.map(len).to_numpy(dtype=np.int64))
    upto = np.append(0, np.cumsum(np.frombuffer(b"".join(data), dtype=np.uint8), dtype=np.int64))
    return pd.Series(np.diff(upto[ends], prepend=0), index=data.index)


def _byte_sum(df):
    return df.withColumn("total", _total("data"))


def tile_pixels(spark, sf):
    tiles = pixels.tile_pixels(_pictures(spark, sf), TileSpec(10, 10))
    return _byte_sum(tiles).select("image_id", "tile_x", "tile_y", "total")


def crop_pixels(spark, sf):
    boxes = fx.annotations(spark, sf).select(
        "image_id", "ann_id", (F.col("x") % 20).alias("x"), (F.col("y") % 12).alias("y"), (F.col("w") % 9 + 1).alias("w"), (F.col("h") % 7 + 1).alias("h")
    )
    crops = pixels.crop_pixels(_pictures(spark, sf), boxes)
    return _byte_sum(crops).select("ann_id", "height", "width", "total")


def warp_pixels(spark, sf):
    pictures = _pictures(spark, sf)
    copies = pictures.select("image_id", "height", "width", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy_no"))
    warped = pixels.warp_pixels(pictures, pixels.warp_parameters(copies, noise=True))
    return warped.select("image_id", "copy_no", "height", "width", F.length("data").alias("bytes"))


def mask_to_classes(spark, sf):
    pictures = _pictures(spark, sf)
    runs = pixels.mask_runs(pictures)
    return pixels.mask_to_classes(relate.class_of_pixel(runs, fx.categories(spark, sf)))


def rasterise_polygons(spark, sf):
    """Octagons moved off the pixel grid, so that no pixel centre lies on an edge."""
    moved = fx.annotations(spark, sf).withColumn("x", F.col("x") + 0.3141)
    runs = pixels.rasterise_polygons(with_octagons(moved))
    return runs.groupBy("ann_id").agg(F.sum(F.col("end") - F.col("start")).alias("pixels"), F.count(F.lit(1)).alias("rows"))


def visible_pixels(spark, sf):
    """Pixels left to each instance when smaller ones lie on top."""
    octagons = with_octagons(fx.annotations(spark, sf))
    runs = pixels.rasterise_polygons(octagons)
    ranked = sampling.overlap_order(octagons.select("image_id", "ann_id", (F.col("w") * F.col("h")).alias("area")))
    top = sampling.top_instance(runs.join(ranked.select("ann_id", "rank"), "ann_id"))
    return top.groupBy("image_id", "ann_id").agg(F.sum(F.col("end") - F.col("start")).alias("pixels"))


_QUERY_NAMES = (
    "parse_metric_lines stream_metrics meters_tumbling meters_sliding meters_session stream_meters stream_novelty stream_preannotate "
    "tile_pixels crop_pixels warp_pixels mask_to_classes rasterise_polygons visible_pixels"
).split()
QUERIES = {n: globals()[n] for n in _QUERY_NAMES}

_BYTE = "((7*r + 13*c + 29*k + image_id) % 251)"
_PIXELS = "px AS MATERIALIZED (SELECT image_id, r, c, sum((7*r + 13*c + 29*k + image_id) % 251) AS s, any_value((7*r + 13*c + image_id) % 251) AS grey FROM images, range(16) a(r), range(24) b(c), range(3) d(k) GROUP BY ALL)"
_VALUES = "v AS (SELECT ts, event_type AS name, floor(value * 4) / 4 AS value FROM events)"
_METERS = "avg(value) AS mean, min(value) AS min, max(value) AS max, count(*) AS n"


def _windows(slide: int, where: str = "") -> str:
    shifts = f"(SELECT CAST(unnest(range({6 // slide})) AS BIGINT) AS k)"
    return f"""WITH {_VALUES}, w AS (SELECT name, value, (epoch_us(ts) // ({slide} * 3600000000) - k) * {slide} * 3600000000 AS start_us FROM v CROSS JOIN {shifts})
        SELECT name, start_us, start_us + 21600000000 AS end_us, {_METERS} FROM w {where} GROUP BY 1, 2"""


SQL = {
    "parse_metric_lines": """SELECT event_id, 'epoch' AS key, '[' || (event_id % 50) || '/50]' AS text, 'int' AS kind, CAST(event_id % 50 AS DOUBLE) AS value FROM events
        UNION ALL SELECT event_id, 'global_step', CAST(event_id AS VARCHAR), 'int', CAST(event_id AS DOUBLE) FROM events
        UNION ALL SELECT event_id, 'loss', CAST(value AS VARCHAR), 'float', value FROM events
        UNION ALL SELECT event_id, 'best', CASE WHEN event_id % 3 = 0 THEN 'none' ELSE CAST(event_id AS VARCHAR) END, CASE WHEN event_id % 3 = 0 THEN 'string' ELSE 'int' END,
          CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END FROM events""",
    "stream_metrics": """WITH f AS (SELECT event_type AS run, event_id % 50 AS epoch, min(event_id) AS event_id FROM events GROUP BY 1, 2)
        SELECT run, epoch, 'loss' AS key, value FROM f JOIN events USING (event_id)
        UNION ALL SELECT run, epoch, 'best', CAST(event_id AS DOUBLE) FROM f WHERE event_id % 3 <> 0""",
    "meters_tumbling": _windows(6),
    "meters_sliding": _windows(2),
    "meters_session": f"""WITH {_VALUES}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY name ORDER BY ts) < INTERVAL 20 MINUTES THEN 0 ELSE 1 END AS fresh FROM v),
        s AS (SELECT *, sum(fresh) OVER (PARTITION BY name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
        SELECT name, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1200000000 AS end_us, {_METERS} FROM s GROUP BY name, no""",
    "stream_meters": _windows(6, "WHERE start_us + 21600000000 <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 3600000000 FROM events)"),
    "stream_preannotate": """WITH d AS (SELECT doc_id, length(text) AS n FROM documents WHERE doc_id % 10 <> 0), p AS (SELECT doc_id, n, unnest(range(CAST(1 + n % 3 AS BIGINT))) AS i FROM d WHERE n > 0),
        b AS (SELECT *, CAST((n*(i + 3)) % 100 AS DOUBLE)/100 AS score, 0.1::DOUBLE*i AS x1, 0.1::DOUBLE*i + 0.2::DOUBLE AS x2 FROM p)
        SELECT doc_id AS image_id, CAST(i + 1 AS INT) AS category_id, CAST(trunc(x1*640) AS INT) AS x, 48 AS y, CAST(trunc((x2 - x1)*640) AS INT) AS w, 192 AS h, round(score, 6) AS score
        FROM b WHERE score >= 0.3""",
    "tile_pixels": fx.with_ctes(
        f"""WITH {_PIXELS}, t AS (SELECT image_id, c//10*10 AS tile_x, r//10*10 AS tile_y, sum(s) AS s, count(*) AS n FROM px GROUP BY ALL)
        SELECT image_id, tile_x, tile_y, CAST(s + (100 - n)*3*114 AS BIGINT) AS total FROM t""",
        "images",
    ),
    "crop_pixels": fx.with_ctes(
        f"""WITH {_PIXELS}, b AS (SELECT image_id, ann_id, CAST(x AS BIGINT) % 20 AS x, CAST(y AS BIGINT) % 12 AS y, CAST(w AS BIGINT) % 9 + 1 AS w, CAST(h AS BIGINT) % 7 + 1 AS h FROM annotations)
        SELECT ann_id, CAST(h AS INT) AS height, CAST(w AS INT) AS width, CAST(sum(s) AS BIGINT) AS total
        FROM b JOIN px ON b.image_id = px.image_id AND c >= x AND c < x + w AND r >= y AND r < y + h GROUP BY ALL""",
        "images", "annotations",
    ),
    "warp_pixels": fx.with_ctes("SELECT image_id, copy_no, 16 AS height, 24 AS width, 1152 AS bytes FROM images CROSS JOIN (SELECT unnest([0, 1]) AS copy_no)", "images"),
    "mask_to_classes": fx.with_ctes(
        f"""WITH {_PIXELS} SELECT image_id, category_id, count(*) AS area, CAST(min(c) AS INT) AS x, CAST(min(r) AS INT) AS y, CAST(max(c) + 1 - min(c) AS INT) AS w, CAST(max(r) + 1 - min(r) AS INT) AS h
        FROM px JOIN categories k ON grey BETWEEN 51*k.category_id - 17 AND 51*k.category_id + 17 WHERE grey <> 0 GROUP BY ALL""",
        "images", "categories",
    ),
    # an octagon's row: the box, narrowed in the upper and lower quarter
    "rasterise_polygons": fx.with_ctes(
        """WITH r AS (SELECT * REPLACE (x + 0.3141::DOUBLE AS x), unnest(range(CAST(y AS BIGINT), CAST(y + h AS BIGINT))) + 0.5 AS c FROM annotations),
        i AS (SELECT *, w*0.25*greatest(0, 1 - (c - y)/(0.25*h), 1 - (y + h - c)/(0.25*h)) AS inset FROM r),
        e AS (SELECT ann_id, ceil(x + w - inset - 0.5) - ceil(x + inset - 0.5) AS n FROM i)
        SELECT ann_id, CAST(sum(n) AS BIGINT) AS pixels, count(*) AS rows FROM e WHERE n > 0 GROUP BY 1""",
        "annotations",
    ),
}
# the octagons' rows, cut at every start and end of a row; the smallest instance that covers a piece is on top
SQL["visible_pixels"] = fx.with_ctes(
    """WITH r AS (SELECT *, unnest(range(CAST(y AS BIGINT), CAST(y + h AS BIGINT))) AS row FROM annotations),
    i AS (SELECT *, row + 0.5::DOUBLE AS c, x + w*0.25 AS xl, x + w*0.75 AS xr, x + w AS xe, y + h*0.25 AS yu, y + h*0.75 AS yl, y + h AS ye FROM r),
    l AS (SELECT *, CASE WHEN c < yu THEN x + (c - yu)*(xl - x)/(y - yu) WHEN c < yl THEN x ELSE xl + (c - ye)*(x - xl)/(yl - ye) END AS a,
                 CASE WHEN c < yu THEN xr + (c - y)*(xe - xr)/(yu - y) WHEN c < yl THEN xe ELSE xe + (c - yl)*(xr - xe)/(ye - yl) END AS b FROM i),
    e AS (SELECT image_id, ann_id, row, w*h AS area, CAST(ceil(a - 0.5) AS BIGINT) AS s, CAST(ceil(b - 0.5) AS BIGINT) AS t FROM l),
    runs AS (SELECT * FROM e WHERE t > s),
    cuts AS (SELECT image_id, row, s AS a FROM runs UNION SELECT image_id, row, t FROM runs),
    pieces AS (SELECT image_id, row, a, lead(a) OVER (PARTITION BY image_id, row ORDER BY a) AS b FROM cuts),
    top AS (SELECT p.image_id, p.row, a, b, arg_min(ann_id, (area, -ann_id)) AS ann_id FROM pieces p JOIN runs u ON u.image_id = p.image_id AND u.row = p.row AND s <= a AND t >= b GROUP BY ALL)
    SELECT image_id, ann_id, CAST(sum(b - a) AS BIGINT) AS pixels FROM top GROUP BY 1, 2""",
    "annotations",
)
from tessera.plans.similarity import SQL as _SIMILARITY_SQL  # noqa: E402

SQL["stream_novelty"] = _SIMILARITY_SQL["novelty_global"]
