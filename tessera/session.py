"""Shared scratch storage and staged tables.

Multi-pass operators (exact ranks, greedy rounds) read an intermediate result
more than once.  They write it as Parquet into the shared folder the cluster
names in ``spark.checkpoint.dir``: that cuts the lineage, survives the loss of
executors, and keeps range-partition numbers fixed between the passes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the session's setting, or a temporary folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    from_context = spark.sparkContext.getCheckpointDir()
    if from_context:
        return from_context
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="tessera-", ignore_cleanup_errors=True)  # gone at exit
    return _local_dirs[app].name


def stage_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/tessera-{app}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark deletes the shuffle files of a query when it ends; here only for the write of a stage, which nothing runs again.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back; the shuffle files of the write do not outlive it."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN)
    conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEAN, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table."""
    return write_stage(df, stage_path(df.sparkSession, name))


def remove_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no later step reads."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


class Scratch:
    """The staged tables of one operator by name; a name that is written again replaces its table."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = stage_path(self.spark, name)
        out = write_stage(df, path)
        self.drop(name)
        self.paths[name] = path
        return out

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            if name in self.paths:
                remove_stage(self.spark, self.paths.pop(name))
