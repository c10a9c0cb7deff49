"""Session helpers: a tuned local session for tests/bench, and the shared
scratch folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library expects; a cluster deployment sets its own
# sizes (shuffle partitions ~ data / 128 MB, executor memory) on top.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle output to the advisory size (64 MB), not to the core
    # count: fewer, fuller tasks on a shared cluster.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, app: str = "ledgerlens",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off); on a cluster the
    launcher's own session is used and only missing settings are added."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it, to shared storage; without it this
    raises there, since every executor would write to a disk of its own. Only
    in local mode (tests) a temporary folder is made and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if root:
            root = root.rsplit("/", 1)[0]
    local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    if not root:
        if not local:
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if "://" not in root and not root.startswith(("/", "file:")):
        if not local:
            raise RuntimeError(f"spark.checkpoint.dir is the relative path {root!r}; name a shared folder in full")
        root = os.path.abspath(root)
    return root.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared scratch root."""
    return f"{scratch_root(spark)}/ledgerlens/{label}-{uuid.uuid4().hex[:12]}"
