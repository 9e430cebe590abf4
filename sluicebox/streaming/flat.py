"""Flat events as they arrive: each micro-batch of files becomes a run of its own in both outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluicebox.operators.flat import add_issues, parse_flat
from sluicebox.plans.flat import write_both
from sluicebox.session import session_with
from sluicebox.sources.flat_files import FILES_PER_TRIGGER, stream_flat_files
from sluicebox.streaming.ingest import ALL_AVAILABLE
from sluicebox.streaming.refine import query_identity

# By default Spark deals 32 small files to a task, which writes files of its own, and looks each file up in a task of its own.
SMALL_FILES = {"spark.sql.files.openCostInBytes": "16384", "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}


def start_flat(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    garbage_path: str,
    checkpoint: str,
    archive: str | None = None,
    suffix: str = ".json",
    files_per_trigger: int = FILES_PER_TRIGGER,
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Check new files of the tree and add them to silver and garbage, each file once.

    A batch writes the run ``<checkpoint's query id>-<batch number>`` and overwrites it when it is repeated after a failure, so
    restarts neither lose nor double an event. Readers take the last run of a file; keep outputs to one checkpoint.

    The source takes its settings from the session that names it, so the query has a session of its own, with those for small files.
    """
    own = session_with(spark, SMALL_FILES)
    checked = add_issues(parse_flat(stream_flat_files(own, bronze_root, suffix, archive, files_per_trigger)))

    def write(batch: DataFrame, number: int) -> None:
        write_both(batch, silver_path, garbage_path, run=f"{query_identity(batch.sparkSession, checkpoint)}-{number:012d}")

    writer = checked.writeStream.foreachBatch(write).outputMode("append").trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).queryName("flat").start()
