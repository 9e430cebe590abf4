"""Compaction of the batch folders that the incremental job leaves.

One compaction at a time per layer, beside any number of readers (``read_silver``, ``read_garbage``) and the job itself. A compaction that dies
leaves folders that do not count and a later ``drop_replaced`` removes; markers appear by one rename, which the file system has to do at
once. Streams over a layer see compacted files as new: filter them by ``batch_number``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicebox.schemas import SILVER_PARTITIONS, SILVER_SCHEMA, TEXT_TIMES
from sluicebox.session import delete_folder, folder_exists, make_folder, move_folder
from sluicebox.sinks.files import laid_out
from sluicebox.sources.batches import MARKER_SCHEMA, MARKERS, Compacted, batch_number, compactions, counting, replaced
from sluicebox.streaming.refine import query_identity

TARGET_BYTES = 1 << 30
PENDING = "_compacting"


def last_closed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that is committed: it and all before it are never written again."""
    names = spark.read.text(f"{checkpoint.rstrip('/')}/commits").select(F.col("_metadata.file_name").alias("name"))
    return names.agg(F.max(F.col("name").try_cast("bigint"))).first()[0]


def folder_sizes(spark: SparkSession, layer_path: str) -> DataFrame:
    """run, batch_id and bytes of all folders with files. Spark lists them; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(layer_path).select("path", "length")
    names = [F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name) for name in ("run", "batch_id")]
    return files.select(*names, "length").groupBy("run", "batch_id").agg(F.sum("length").alias("bytes"))


def due(sizes: DataFrame, target_bytes: int, closed_only: bool = True) -> DataFrame:
    """Ranges of consecutive batches, per run, that together reach the target: run, first, last.

    The window sees one number per batch folder, not rows. The last range of a run is left to grow unless ``closed_only`` is off.
    """
    in_order = Window.partitionBy("run").orderBy("batch")
    before = F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    parts = sizes.withColumn("batch", batch_number()).withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / target_bytes))
    ranges = parts.groupBy("run", "part").agg(
        F.min("batch").alias("first"), F.max("batch").alias("last"), F.count(F.lit(1)).alias("folders")
    )
    newest = F.max("part").over(Window.partitionBy("run"))
    grown = ranges.withColumn("newest", newest).filter((F.col("part") < F.col("newest")) | F.lit(not closed_only))
    return grown.filter("folders > 1").select("run", "first", "last")


def compact(
    spark: SparkSession,
    layer_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    target_bytes: int = TARGET_BYTES,
    closed_only: bool = True,
    layout: str = "rebalance",
) -> list[Compacted]:
    """Merge closed batches of one checkpoint's run into folders of about ``target_bytes`` and name them in a marker.

    All ranges are written by one Spark job. What comes back, and what the driver holds, is one row per new folder.
    ``fmt`` is ``parquet`` for silver and ``json`` for garbage.
    """
    layer = layer_path.rstrip("/")
    run, last = query_identity(spark, checkpoint), last_closed_batch(spark, checkpoint)
    if last is None or not folder_exists(spark, f"{layer}/run={run}"):
        return []
    make_folder(spark, f"{layer}/{MARKERS}")  # from now on readers count folders
    markers = compactions(spark, layer) or []
    closed = folder_sizes(spark, layer).filter((F.col("run") == run) & (batch_number() <= last) & counting(markers))
    token = uuid.uuid4().hex
    added = [Compacted(r["run"], r["first"], r["last"], f"c{r['first']}-{r['last']}-{token}") for r in due(closed, target_bytes, closed_only).collect()]
    if added:
        write_folders(spark, layer, added, fmt, layout)
        publish(spark, layer, added, token)
    return added


def write_folders(spark: SparkSession, layer: str, added: list[Compacted], fmt: str, layout: str) -> None:
    """The merged folders, which do not count yet."""
    keys = list(SILVER_PARTITIONS) if fmt == "parquet" else []
    target = F.coalesce(*[F.when(replaced([m]), F.lit(m.folder)) for m in added])
    schema = T.StructType([*SILVER_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in ("run", "batch_id")]])
    rows = spark.read.schema(schema).options(**_options(fmt)).format(fmt).load(layer)
    rows = rows.filter(replaced(added)).withColumn("batch_id", target)
    writer = laid_out(rows, ["run", "batch_id", *keys], layout).write.mode("append").partitionBy("run", "batch_id", *keys)
    writer.options(**_options(fmt)).format(fmt).save(layer)


def _options(fmt: str) -> dict[str, str]:
    return TEXT_TIMES if fmt == "json" else {}


def publish(spark: SparkSession, layer: str, added: list[Compacted], token: str) -> None:
    """From the rename on, the new folders count and those they replace do not."""
    rows = spark.createDataFrame([(m.run, m.first, m.last, m.folder) for m in added], MARKER_SCHEMA)
    rows.coalesce(1).write.json(f"{layer}/{PENDING}/id={token}")
    move_folder(spark, f"{layer}/{PENDING}/id={token}", f"{layer}/{MARKERS}/id={token}")


def drop_replaced(spark: SparkSession, layer_path: str) -> int:
    """Remove folders that do not count any more, and what compactions that died have left; the number of folders removed.

    Readers that listed the layer earlier still need replaced folders, so call this as long after a compaction as the longest
    of them runs, and not beside a compaction.
    """
    layer = layer_path.rstrip("/")
    markers = compactions(spark, layer)
    if markers is None:
        return 0
    gone = folder_sizes(spark, layer).filter(~counting(markers)).select("run", "batch_id").collect()  # names of folders
    for run, batch_id in gone:
        delete_folder(spark, f"{layer}/run={run}/batch_id={batch_id}")
    delete_folder(spark, f"{layer}/{PENDING}")
    return len(gone)
