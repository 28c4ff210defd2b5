"""Session construction and the shared scratch location.

Intermediate and stored outputs go below the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a cluster).  Only when the
session has none — a local test run — do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ratewise", **extra: str) -> SparkSession:
    """A session tuned for these jobs: AQE on (coalescing, skew-join split,
    runtime broadcast of small measured sides), UI off."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests, a laptop) without one gets a folder of
    our own; on a cluster a machine-local folder would not be visible to the
    executors, so an unset setting is an error there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                           "object store): intermediate tables are written below it")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratewise-ckpt-"))
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/ratewise/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint folder (never reused), in this
    application's own folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote to scratch paths; frames that
    still read it cannot be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for local checks in tests."""
    return uri[5:] if uri.startswith("file:") else uri


def exists_locally(uri: str) -> bool:
    return os.path.exists(local_path(uri))
