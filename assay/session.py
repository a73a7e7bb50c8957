"""Session settings, and the shared folder that staged tables and checkpoints go to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Bytes of shuffle data one task should hold; AQE merges what turns out smaller.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for an input size: never fewer than the cores."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def build_session(
    app: str = "assay", master: str | None = None, **extra: str
) -> SparkSession:
    """A session with the settings every operator here assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results on a session somebody else built."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="assay-"))
        root = context.getCheckpointDir()
    return "/".join([root.rstrip("/"), context.applicationId, *parts])
