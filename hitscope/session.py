"""Session helpers.

Library code never sets a master. ``configure`` pins the settings that change the
*meaning* of results (UTC session zone). ``EXECUTION_CONF`` is what the local sessions of
tests and bench also set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A whole-stage method over 8000 bytes is never JIT-compiled by HotSpot and runs
    # interpreted; at this limit Spark generates per-operator code for such a stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on (idempotent); how plans run is the caller's choice."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "hitscope") -> SparkSession:
    """A local session for tests and the bench (not used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("HITSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (what a cluster names), else the context's
    checkpoint dir. Only a local-mode session (tests) without either gets a folder of
    its own; on a cluster a machine-local folder would be wrong, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        root = tempfile.mkdtemp(prefix="hitscope-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared root (never reused, never cleared)."""
    return "/".join([shared_root(spark), "hitscope", *parts, uuid.uuid4().hex])
