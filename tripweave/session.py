"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Plan-shaping settings; executor counts and memory belong to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where it names none, a session on this machine alone may use a folder here, as in tests.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tripweave-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/tripweave/{name}-{uuid.uuid4().hex}"


def written(table: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read back: a cut in the lineage that
    outlives executors."""
    path = scratch_path(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
