"""Which batch folders of a layer count, once some of them have been compacted.

A layer of the incremental job has a folder ``run=<query id>/batch_id=<number>`` per batch. Compaction adds folders whose names are no numbers and
then names them, with the range of batches each replaces, in one marker folder ``_compactions/id=<id>`` that appears by a rename. Until
then its folders do not count, afterwards the replaced batches do not. Nothing that counts is ever changed or removed, so rows are the
same before, during and after.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.session import folder_exists

MARKERS = "_compactions"
MARKER_SCHEMA = "run STRING, first BIGINT, last BIGINT, folder STRING"
FOLDER_COLUMNS = "run STRING, batch_id STRING"


@dataclass(frozen=True, order=True)
class Compacted:
    """Batches ``first`` to ``last`` of a run are in ``folder``."""

    run: str
    first: int
    last: int
    folder: str


def batch_number() -> Column:
    """The number of a batch folder; null for a folder made by compaction."""
    return F.col("batch_id").try_cast("bigint")


def compactions(spark: SparkSession, layer_path: str) -> list[Compacted] | None:
    """All markers, one row per compacted folder; None where nothing was ever compacted."""
    path = f"{layer_path.rstrip('/')}/{MARKERS}"
    if not folder_exists(spark, path):
        return None
    return sorted(Compacted(*row) for row in spark.read.schema(MARKER_SCHEMA).json(path).select("run", "first", "last", "folder").collect())


def replaced(markers: list[Compacted]) -> Column:
    """Whether the row's batch folder is among those that markers replace. Adjoining ranges are tested as one."""
    ranges: list[tuple[str, int, int]] = []
    for marker in markers:
        if ranges and ranges[-1][0] == marker.run and ranges[-1][2] + 1 == marker.first:
            ranges[-1] = (marker.run, ranges[-1][1], marker.last)
        else:
            ranges.append((marker.run, marker.first, marker.last))
    covered = F.lit(False)
    for run, first, last in ranges:
        covered = covered | ((F.col("run") == run) & batch_number().between(first, last))
    return covered


def counting(markers: list[Compacted]) -> Column:
    """Partition filter for the folders that count."""
    named = F.concat_ws("/", "run", "batch_id").isin([f"{m.run}/{m.folder}" for m in markers])
    return (batch_number().isNotNull() & ~replaced(markers)) | (batch_number().isNull() & named)


def read_batches(spark: SparkSession, layer_path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """The layer's rows. ``read`` takes further columns as DDL and lists the files at once.

    Files are listed between two looks at the markers: when those agree, every folder that counts was listed whole.
    """
    before = compactions(spark, layer_path)
    while True:
        if before is None:
            rows = read("")
        else:
            rows = read(FOLDER_COLUMNS).filter(counting(before)).drop("run", "batch_id")
        after = compactions(spark, layer_path)
        if after == before:
            return rows
        before = after
