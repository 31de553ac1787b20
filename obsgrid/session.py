"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "obsgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings these jobs rely on; cluster sizing stays with the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Percentiles use object aggregates; keep them hashed for a few thousand groups per task.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session whose tasks all run in this process gets a folder of its own when there is
    no setting; any cluster, a local one included, must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="obsgrid-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/obsgrid/{label}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there. Errors in reaching it are raised, never taken for absence."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Drop a scratch path that nothing reads any more."""
    if "/obsgrid/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
