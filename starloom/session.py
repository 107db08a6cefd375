"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the library is meant to run with; partition counts are left to the cluster's own configuration."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="starloom-")


def work_folder(spark: SparkSession) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of this machine; on a cluster the
    executors could not see it, so there the missing setting is an error.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the written copy, so that lost executors cannot change its values."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a work folder made by :func:`work_folder` once nothing reads it any more."""
    if "/work-" not in path:
        raise ValueError(f"not a work folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
