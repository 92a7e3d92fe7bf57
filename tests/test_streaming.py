"""Streams over several micro-batches against the batch rules."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tessera.streaming import metrics, tables
from tests.test_skew import brute_novelty, cloud


def test_every_epoch_is_reported_once(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    stream = metrics.stream_metrics(metrics.read_log_stream(spark, str(logs)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    (logs / "run1.log").write_text("x INFO: epoch: [1/9], global_step: 10, loss: 0.5, note: hi\nx INFO: epoch: [1/9], global_step: 20, loss: 0.4\nplain\n")
    metrics.run_to_table(stream, out, state)
    (logs / "run1.2.log").write_text("x INFO: epoch: [1/9], global_step: 30, loss: 0.3\nx INFO: epoch: [2/9], global_step: 40, loss: 0.2\n")
    rows = metrics.run_to_table(stream, out, state).collect()
    assert sorted((r["run"], r["epoch"], r["key"], r["value"]) for r in rows) == [("run1", 1, "loss", 0.5), ("run1", 2, "loss", 0.2)]


def test_epoch_flags_leave_the_state_behind_the_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "ts timestamp, run string, line string"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    (tmp_path / "src").mkdir()
    raw = spark.readStream.schema(schema).parquet(src)
    stream = metrics.stream_metrics(raw, ts="ts", late_by="10 minutes", idle="30 minutes")
    sizes, batches = [], [
        [(at(e), "r", f"INFO: epoch: [{e}/9], global_step: {e}, loss: 0.{e}") for e in range(1, 6)],
        [(at(20), "r", "INFO: epoch: [5/9], global_step: 9, loss: 0.9")],  # known still
        [(at(120), "r", "INFO: epoch: [6/9], global_step: 10, loss: 0.6")],  # all others have been silent
        [(at(3), "r", "INFO: epoch: [3/9], global_step: 11, loss: 0.8")],  # too late
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        query = (
            stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r["epoch"], r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0.1), (2, 0.2), (3, 0.3), (4, 0.4), (5, 0.5), (6, 0.6)]
    assert sizes[0] == sizes[1] == 5 and sizes[-1] == 1


def test_sessions_in_slices_equal_the_session_window(spark):
    rng = np.random.default_rng(5)
    minutes = np.concatenate([rng.integers(0, 3000, 300), np.arange(4000, 4700, 7), [5000, 5010, 5030]])  # a long session, gaps of exactly ten
    names = np.where(rng.random(len(minutes)) < 0.6, "hot", "cold")
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m)), str(k), float(m % 8) / 4) for m, k in zip(minutes, names)]
    rows += [(dt.datetime(2024, 1, 1), "hot", None), (None, "hot", 1.0)]
    values = spark.createDataFrame(rows, "ts timestamp, name string, value double")
    window = values.groupBy(F.session_window("ts", "10 minutes").alias("s"), "name").agg(
        F.avg("value").alias("mean"), F.min("value"), F.max("value"), F.count(F.lit(1)).alias("n")
    ).select("name", F.unix_micros("s.start"), F.unix_micros("s.end"), "mean", "min(value)", "max(value)", "n")
    want = sorted(map(tuple, window.collect()), key=repr)
    for part in ("1 hour", "1 day", "1 minute"):
        got = metrics.windowed_meters(values, "ts", "name", "value", "", gap="10 minutes", part=part)
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_late_rows_are_left_out(spark, tmp_path):
    (tmp_path / "src").mkdir()
    src = str(tmp_path / "src")
    schema = "ts timestamp, name string, value double"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    stream = metrics.windowed_meters(spark.readStream.schema(schema).parquet(src), "ts", "name", "value", "10 minutes", late_by="5 minutes")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for rows in ([(at(1), "a", 1.0), (at(40), "a", 2.0)], [(at(2), "a", 100.0), (at(41), "a", 4.0)], [(at(90), "a", 8.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        got = metrics.run_to_table(stream, out, state)
    assert sorted((r["mean"], r["n"]) for r in got.collect()) == [(1.0, 1), (3.0, 2)]


def test_stream_novelty_carries_what_was_kept(spark, tmp_path):
    x = cloud()
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "id long, vector array<float>"
    for part in np.array_split(np.arange(len(x)), 3):
        spark.createDataFrame([(int(i), [float(v) for v in x[i]]) for i in part], schema).coalesce(1).write.mode("append").parquet(src)
        tables.stream_novelty(spark.readStream.schema(schema).parquet(src), 1.0, out, state).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == brute_novelty(x, 1.0)


def _model():
    return lambda inputs: [[(0, 0, 0.9, 0.0, 0.0, 0.5, 0.5, None)] for _ in inputs]


def test_stream_preannotate_skips_annotated_and_done_images(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "image_id long, width int, height int, content string"
    cats = spark.createDataFrame([(1, "cat")], "category_id int, name string")
    labelmap = spark.createDataFrame([(0, "cat")], "class_idx int, label string")

    def annotated():
        return spark.createDataFrame([(2,)], "image_id long")

    for ids in ([1, 2], [1, 3]):
        spark.createDataFrame([(i, 100, 80, "x") for i in ids], schema).coalesce(1).write.mode("append").parquet(src)
        tables.stream_preannotate(
            spark.readStream.schema(schema).parquet(src), annotated, _model, cats, labelmap, "detection", 0.5, out, state
        ).awaitTermination()
    rows = spark.read.parquet(out).orderBy("image_id").select("image_id", F.col("w"), "h").collect()
    assert [tuple(r) for r in rows] == [(1, 50, 40), (3, 50, 40)]
