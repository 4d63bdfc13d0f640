"""Session settings the queries rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# The source column is UTC by name, and hour(), year() ... follow the session zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Checkpointed tables are deleted once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "wattloom") -> SparkSession:
    """A session with the settings above; master, memory and cores are left to deployment."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the session's zone, for good: hour() and the like follow it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it.

    Read from ``spark.checkpoint.dir`` (or the context, if a checkpoint folder was set there).
    Only a local master, where all tasks share one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and getattr(context, "_wattloom_dir", None) != configured:
        context.setCheckpointDir(configured)  # checkpoints and written tables go to one folder
        context._wattloom_dir = configured
    if configured or context.getCheckpointDir():
        return configured or context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="wattloom-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; it is deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python, once per context, for functions that run there.

    A deployment may have installed it already; then the copy does no harm.
    """
    context = spark.sparkContext
    if not getattr(context, "_wattloom_shipped", False):
        folder = tempfile.mkdtemp(prefix="wattloom-package-")
        package = Path(__file__).resolve().parent
        context.addPyFile(
            shutil.make_archive(f"{folder}/wattloom", "zip", package.parent, package.name)
        )
        context._wattloom_shipped = True
    return spark
