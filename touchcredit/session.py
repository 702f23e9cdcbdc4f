"""Session helpers: UTC pinning, a local session for tests/bench, and the
shared folder for lineage cuts and streaming state."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> None:
    """All time arithmetic is done on integer micros; the few zoned
    conversions (``timestamp_micros``, date formatting) assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "touchcredit") -> SparkSession:
    """Session for tests and the local bench (no UI, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TOUCHCREDIT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's checkpoint dir (``spark.checkpoint.dir``).

    The cluster names that shared folder. Unset is an error: executors and
    driver share no local disk, so none can be picked here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = root.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def cut_lineage(df, name: str):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    For plans that use one expensive relation in several branches: column
    pruning makes each branch's copy of the plan differ, so Spark cannot
    reuse the exchange and would recompute it per branch. The written table
    also survives executor loss (never ``localCheckpoint``)."""
    import uuid

    spark = df.sparkSession
    path = shared_dir(spark, "touchcredit", "cut", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Target bytes per task for scans and shuffles (fits comfortably in an
# executor core's share of memory with room for sort buffers).
TARGET_TASK_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` from file-system metadata (no scan)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def scale_conf(total_input_bytes: int, shuffle_fraction: float = 0.3) -> dict[str, str]:
    """Settings sized to the input: scan splits and AQE's target partition
    size at ``TARGET_TASK_BYTES``; initial shuffle partitions so that the
    largest shuffle (the credit union, about ``shuffle_fraction`` of the
    input after projection) starts at ~1 target per partition, and AQE
    coalesces from there. Skew splitting stays on."""
    shuffle_bytes = max(1, int(total_input_bytes * shuffle_fraction))
    parts = max(200, shuffle_bytes // TARGET_TASK_BYTES + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_TASK_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(TARGET_TASK_BYTES),
        "spark.sql.shuffle.partitions": str(parts),
    }


def apply_scale_conf(spark: SparkSession, total_input_bytes: int, override: bool = False) -> dict[str, str]:
    """Set the ``scale_conf`` values the session does not set already
    (the cluster's own settings win unless ``override``)."""
    applied = {}
    for k, v in scale_conf(total_input_bytes).items():
        if override or spark.conf.get(k, None) is None:  # None: not set by anyone
            spark.conf.set(k, v)
            applied[k] = v
    return applied
