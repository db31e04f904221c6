"""Session construction and shared-storage settings."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: wall-clock timestamps are compared as UTC,
# AQE re-plans joins and coalesces small shuffles, and skewed join partitions
# are split at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # day-partitioned writes: keep up to this many files open per task instead
    # of sorting every task's rows by the partition column (falls back to the
    # sort beyond it)
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gatewise", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the jobs assume.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    input (about 128-256 MB of shuffle data per partition); AQE coalesces the
    rest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Uses ``spark.checkpoint.dir``. When it is unset, a single-machine session
    (master ``local``) gets a scratch folder of its own; on a cluster that
    folder would be a different one on every machine, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    local = tempfile.mkdtemp(prefix="gatewise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``spark-submit --py-files`` does,
    once per application: their Python workers import its helpers."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gatewise-")) / f"{package.name}.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
