"""Session helpers: a local session for tests/bench and the shared scratch folder.

The library never creates a session of its own inside operators; callers own it.
Scratch output (CSV round trips, written intermediate tables) always goes under the
folder the cluster names in ``spark.checkpoint.dir`` so that every executor sees it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "qualia") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``, UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")  # plans show whole paths
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder from the session; called where one is needed.

    Only a local-mode session (tests, the bench) without one gets a private temporary
    folder; on a cluster the folder must be configured (a machine-local folder is not
    visible to other executors), so an unset value is an error there.
    """
    current = checkpoint_dir(spark, required=False)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on storage every executor can reach")
    path = tempfile.mkdtemp(prefix="qualia-ckpt-")
    # spark.checkpoint.dir is a core setting (fixed at startup); the context's checkpoint
    # folder is what checkpoint_dir() falls back to.
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The cluster-wide checkpoint folder named by ``spark.checkpoint.dir`` (or set on the context)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
        if path and path.startswith("file:"):
            path = path[len("file:"):]
    if not path and required:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder every executor can reach")
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "qualia", f"{name}-{uuid.uuid4().hex}")
