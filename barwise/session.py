"""Session settings and the shared scratch location.

Library code never builds its own session; callers pass one. ``local_session``
is for tests, benchmarks and notebooks. ``scratch_path`` hands out table
locations under the folder the cluster names in ``spark.checkpoint.dir``;
only when that setting is absent (local runs, tests) does it pick one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: str | None = None

# Settings every job of the library is written against. AQE re-plans joins by
# runtime size, coalesces small shuffle partitions and splits skewed ones.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "barwise", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, loopback driver)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SQL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``). When unset, as in
    tests, a local folder is created once and registered as the checkpoint
    dir of the context.
    """
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context
        sc = None
    if sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if root:
            return root.rstrip("/")
        current = sc.getCheckpointDir()
        if current:
            return os.path.dirname(current.rstrip("/"))
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="barwise-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_ROOT)
    return _LOCAL_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the checkpoint root."""
    return f"{checkpoint_root(spark)}/barwise/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20,
                   max_partitions: int = 200_000) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` (cluster configs).

    Scan splits of ``partition_bytes``; the initial shuffle partition count
    keeps each reduce partition near the same size (capped), and AQE
    coalesces small ones toward the advisory size and splits skewed ones
    (over 5x the median and over 1 GB). Apply with ``spark.conf.set``.
    """
    parts = max(1, min(max_partitions, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
