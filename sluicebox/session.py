"""Session settings and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the library is tuned for. They are ordinary Spark options: a cluster may override any.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits one hot bank and channel into many write tasks after the rebalance hint.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of a rebalanced write task, hence of a silver file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # INT96 carries no min/max statistics; with micros, time filters skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The last of two equal JSON keys wins, also inside nested values of flat events.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "sluicebox", master: str | None = None, **options: str) -> SparkSession:
    """A session with the defaults above; ``options`` take dots as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("__", "."): v for k, v in options.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def session_with(spark: SparkSession, values: dict[str, str]) -> SparkSession:
    """A session beside this one with its settings, and these where this one has none of its own; views and functions are copied, too."""
    beside = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in values.items():
        if spark.conf.get(key, None) is None:
            beside.conf.set(key, value)
    return beside


_folder: dict[str, str] = {}  # one for the process, as stream callbacks run in threads of their own


def use_folder(path: str) -> None:
    """Names the folder for intermediate data where the session has no ``spark.checkpoint.dir``."""
    _folder["path"] = path


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one every executor can reach: ``spark.checkpoint.dir``, or what ``use_folder`` names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _folder.get("path")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share, or name one by use_folder")
    return f"{base.rstrip('/')}/sluicebox/{purpose}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything under this name, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder on its file system."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{path} could not be renamed to {to}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
