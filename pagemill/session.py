"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

ARCHIVE = "pagemill.zip"

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings that hold at any size: the optimizer re-plans from observed sizes, splits
# skewed join sides, and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are large binaries: keep batches small so that a task holds few of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


# Shuffled bytes per partition.
PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions that keep a shuffle of ``input_bytes`` in the memory of its tasks."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "pagemill", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with :data:`SETTINGS`, sized for ``input_bytes``; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for name, value in {**settings, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it.

    Needed once per application, unless it is installed there or given to spark-submit
    with ``--py-files``.
    """
    context = spark.sparkContext
    if any(os.path.basename(path) == ARCHIVE for path in context._python_includes):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="pagemill-"), ARCHIVE)
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)


def working_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary one, because a folder on one
    machine is not visible to other executors.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="pagemill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
