"""Micro-batch jobs that need whole-batch operators: novelty and pre-annotation of arriving rows.

Every micro-batch writes its own folder ``batch=<id>`` and overwrites it when
it is retried, so a lost executor or a restarted query repeats no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.predict import batch_predict, preannotate
from tessera.operators.similarity import near_semi_join, novelty_global


def _earlier(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame | None:
    """Rows of the batches before ``batch_id``; a half-written later batch is never read."""
    if batch_id == 0:
        return None
    rows = spark.read.schema(f"{schema}, batch long").parquet(path).filter(F.col("batch") < batch_id).drop("batch")
    return rows


def stream_novelty(vectors: DataFrame, t: float, out: str, checkpoint: str) -> StreamingQuery:
    """Keep arriving vectors (id, vector) that are farther than ``t`` from all kept ones, in arrival order of batches.

    Kept rows are appended to Parquet at ``out``; inside a batch rows count in id order.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = _earlier(spark, out, "id long, vector array<float>", batch_id)
        fresh = batch
        if kept is not None and not kept.isEmpty():
            fresh = batch.join(near_semi_join(batch, kept, t), "id", "left_anti")
        new = fresh.join(novelty_global(fresh, t), "id", "left_semi")
        new.select("id", "vector").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        vectors.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_preannotate(
    images: DataFrame,
    annotated: Callable[[], DataFrame],
    make_model: Callable[[], Callable],
    categories: DataFrame,
    labelmap: DataFrame,
    task: str,
    threshold: float,
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Score arriving images (image_id, width, height, content) and write their annotations to ``out``.

    Images that ``annotated()`` lists (read afresh per batch) or that an earlier
    batch has scored are skipped.  Failing images are left out.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = batch.join(annotated().select("image_id"), "image_id", "left_anti")
        done = _earlier(spark, out, "image_id long", batch_id)
        if done is not None:
            todo = todo.join(done.distinct(), "image_id", "left_anti")
        found = batch_predict(todo, make_model).filter(F.col("error").isNull())
        rows = preannotate(found, todo.select("image_id", "width", "height"), categories, labelmap, task, threshold, on_unknown="drop", number=False)
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return images.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
