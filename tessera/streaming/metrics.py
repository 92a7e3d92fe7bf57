"""Streams of training metrics: log lines to metric rows, windowed meters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.text import metric_kind, metric_number, metric_pairs

# Keys of a log line that locate it and are no metrics themselves.
LOCATING_KEYS = ("epoch", "global_step")


def parse_metric_lines(lines: DataFrame, tag: str = "INFO:") -> DataFrame:
    """(other columns, key, text, kind, value) from a ``line`` column."""
    others = [c for c in lines.columns if c != "line"]
    pairs = lines.select(*others, F.explode(metric_pairs(F.col("line"), tag)).alias("_p")).select(*others, "_p.*")
    key, text = F.col("key"), F.col("text")
    return pairs.select(*others, "key", "text", metric_kind(key, text).alias("kind"), metric_number(key, text).alias("value"))


def _number_of(line: Column, tag: str, key: str) -> Column:
    found = F.filter(metric_pairs(line, tag), lambda p: p["key"] == key)
    first = F.get(found, 0)
    return metric_number(first["key"], first["text"]).cast("long")


def epoch_lines(lines: DataFrame, tag: str) -> DataFrame:
    """Lines that name an epoch, with ``epoch`` and ``step``."""
    named = lines.filter(F.col("line").contains("epoch:"))
    placed = named.withColumn("epoch", _number_of(F.col("line"), tag, "epoch")).withColumn("step", _number_of(F.col("line"), tag, "global_step"))
    return placed.filter(F.col("epoch").isNotNull())


def first_lines(placed: DataFrame) -> DataFrame:
    """Batch form: the line with the lowest step per (run, epoch)."""
    order = F.struct(F.coalesce("step", F.lit(2**62)).alias("s"), "line")
    return placed.groupBy("run", "epoch").agg(F.min(order).alias("_f")).select("run", "epoch", F.col("_f.line").alias("line"))


def metrics_of(first: DataFrame, tag: str) -> DataFrame:
    """Numeric metrics of reported lines, without the locating keys."""
    parsed = parse_metric_lines(first, tag)
    return parsed.filter(~F.col("key").isin(*LOCATING_KEYS) & F.col("value").isNotNull()).select("run", "epoch", "key", "value")


def _first_line(key: tuple, frames: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    """The first line of a (run, epoch) by step."""
    best = None
    for pdf in frames:
        at = min(zip(pdf["step"].fillna(2**62), pdf["line"]), default=None)
        if at is not None and (best is None or at < best):
            best = at
    return None if best is None else pd.DataFrame({"run": [key[0]], "epoch": [key[1]], "line": [best[1]]})


def _report_once(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The epoch's first line; later micro-batches of the same epoch report nothing."""
    found = _first_line(key, batches)
    if not state.exists and found is not None:
        state.update((True,))
        yield found


def _report_until_silent(idle_ms: int):
    """``_report_once`` whose state leaves when the watermark is ``idle_ms`` past the epoch's last line."""

    def report(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None

        def watched() -> Iterator[pd.DataFrame]:
            nonlocal last
            for pdf in batches:
                if len(pdf):
                    here = int(pdf["at_ms"].max())
                    last = here if last is None else max(last, here)
                yield pdf

        found, known = _first_line(key, watched()), state.exists
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(last + idle_ms)
        if found is not None and not known:
            yield found

    return report


def stream_metrics(
    lines: DataFrame, tag: str = "INFO:", ts: str | None = None, late_by: str = "1 hour", idle: str = "1 day"
) -> DataFrame:
    """Metric rows (run, epoch, key, value) of a stream of log lines (run, line); every epoch is reported once.

    The state is one flag per (run, epoch).  With an event time ``ts`` it stays
    bounded: lines later than ``late_by`` are left out, and an epoch's flag goes
    once the watermark is ``idle`` past its last line; a line after such a
    silence would be reported as a new epoch.  Without ``ts`` flags are kept.
    """
    placed = epoch_lines(lines, tag)
    step = F.col("step").cast("double").alias("step")
    schema = "run string, epoch long, line string"
    if ts is None:
        first = placed.select("run", "epoch", step, "line").groupBy("run", "epoch").applyInPandasWithState(
            _report_once, schema, "reported boolean", "append", GroupStateTimeout.NoTimeout
        )
        return metrics_of(first, tag)
    idle_ms = _micros(lines.sparkSession, idle) // 1000
    timed = placed.withWatermark(ts, late_by).select("run", "epoch", step, "line", F.unix_millis(ts).alias("at_ms"), F.col(ts))
    first = timed.groupBy("run", "epoch").applyInPandasWithState(
        _report_until_silent(idle_ms), schema, "last_ms long", "append", GroupStateTimeout.EventTimeTimeout
    )
    return metrics_of(first, tag)


def _micros(spark: SparkSession, length: str) -> int:
    """Microseconds of a length of time such as ``20 minutes``."""
    return spark.range(1).select(F.expr(f"unix_micros(TIMESTAMP_MICROS(0) + INTERVAL {length})")).first()[0]


def read_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of (run, line) from log files below ``path``; the run is the file's stem."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(path)
    return raw.select(F.substring_index(F.col("_metadata.file_name"), ".", 1).alias("run"), F.col("value").alias("line"))


# ---------------------------------------------------------------- windowed meters


def _sessions(values: DataFrame, ts: str, key: str, value: str, gap: str, part: str) -> DataFrame:
    """Session meters of a batch: sessions inside time slices first, then those at slice edges joined up.

    A key is as many groups as it has slices.  Only a session that may go on
    beyond its slice meets its neighbours, at most two rows per key and slice,
    however many values the key has.
    """
    spark = values.sparkSession
    gap_us = _micros(spark, gap)
    part_us = max(_micros(spark, part), gap_us)  # so that only neighbouring slices can touch
    sliced = values.filter(F.col(ts).isNotNull()).withColumn("_slice", F.floor(F.unix_micros(ts) / F.lit(part_us)).cast("long"))
    parts = sliced.groupBy(F.session_window(ts, gap), F.col(key), "_slice").agg(
        # not the window's own ends: filters on those would move below the merging of sessions
        F.min(F.unix_micros(ts)).alias("start_us"), (F.max(F.unix_micros(ts)) + gap_us).alias("end_us"),
        F.sum(value).alias("sum"), F.count(value).alias("known"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n")
    )
    first, beyond = F.col("_slice") * part_us, (F.col("_slice") + 1) * part_us
    parts = parts.withColumn("_edge", (F.col("start_us") < first + gap_us) | (F.col("end_us") >= beyond))
    order = Window.partitionBy(key).orderBy("start_us")
    fresh = F.coalesce(F.col("start_us") > F.lag("end_us").over(order), F.lit(True)).cast("long")
    edges = parts.filter("_edge").withColumn("_fresh", fresh).withColumn("_no", F.sum("_fresh").over(order))
    joined = edges.groupBy(key, "_no").agg(
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("sum").alias("sum"), F.sum("known").alias("known"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("n").alias("n"),
    )
    columns = [F.col(key), "start_us", "end_us", F.try_divide("sum", "known").alias("mean"), "min", "max", "n"]
    return parts.filter("NOT _edge").select(*columns).unionByName(joined.select(*columns))


def windowed_meters(
    values: DataFrame,
    ts: str,
    key: str,
    value: str,
    length: str,
    slide: str | None = None,
    gap: str | None = None,
    late_by: str | None = None,
    part: str = "1 day",
) -> DataFrame:
    """Mean, minimum, maximum and count per key and window, in batch and on streams.

    ``length`` alone gives tumbling windows, ``slide`` sliding ones, ``gap``
    sessions.  On a stream ``late_by`` sets the watermark: rows later than that
    are left out and finished windows leave the state.  Fixed windows combine
    map-side; sessions of a batch are built per time slice of length ``part``
    and joined at its edges, so one busy key does not load one task.  On a
    stream a session's state is kept by Spark under its key.
    """
    if gap and not values.isStreaming:
        return _sessions(values, ts, key, value, gap, part)
    if late_by is not None:
        values = values.withWatermark(ts, late_by)
    span = F.session_window(ts, gap) if gap else F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = values.groupBy(span.alias("span"), F.col(key)).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n")
    )
    return grouped.select(
        key, F.unix_micros("span.start").alias("start_us"), F.unix_micros("span.end").alias("end_us"), "mean", "min", "max", "n"
    )


def run_to_table(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available, into Parquet at ``out``, and read the result."""
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
