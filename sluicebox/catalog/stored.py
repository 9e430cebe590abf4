"""Layers written from the test tables, once per session and table folder."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import AS_OF, customers_as_events, flat_texts, kafka_records, read_events
from sluicebox.operators.bronze import to_bronze
from sluicebox.plans.refine import Targets, run_refine
from sluicebox.session import make_folder, move_folder, shared_folder
from sluicebox.sinks.clustered import write_clustered_silver
from sluicebox.sources.flat_files import tasks_open
from sluicebox.sources.layers import read_silver


@dataclass(frozen=True)
class StoredLayers:
    bronze: str
    silver: str
    garbage: str
    csv: str


_stored: dict[tuple[str, str], StoredLayers] = {}


def stored_layers(spark: SparkSession, sf_dir: str) -> StoredLayers:
    """Bronze, and what one refinement run makes of it, in a fresh shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        base = shared_folder(spark, "layers")
        layers = StoredLayers(*(f"{base}/{name}" for name in ("bronze", "silver", "garbage", "csv")))
        to_bronze(kafka_records(read_events(spark, sf_dir))).write.parquet(layers.bronze)
        run_refine(spark, layers.bronze, Targets(layers.silver, layers.garbage, csv=layers.csv), AS_OF)
        _stored[key] = layers
    return _stored[key]


_clustered: dict[tuple[str, str], str] = {}
CLUSTERED_PARTS = 64


def clustered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver rows, laid out for look-ups."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _clustered:
        path = shared_folder(spark, "clustered")
        write_clustered_silver(read_silver(spark, stored_layers(spark, sf_dir).silver), path, parts=CLUSTERED_PARTS)
        _clustered[key] = path
    return read_silver(spark, _clustered[key])


TREE_SUFFIX = ".txt"  # what Spark's text writer calls its files


_trees: dict[tuple[str, str], str] = {}


def stored_tree(spark: SparkSession, sf_dir: str) -> str:
    """The tree that scans read, written once: one file per row of ``customer`` and a folder without any file."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        tree = flat_tree(spark, customers_as_events(spark, sf_dir))
        make_folder(spark, f"{tree}/bank_d/atm")
        _trees[key] = tree
    return _trees[key]


def flat_tree(spark: SparkSession, events: DataFrame) -> str:
    """The flat events as a tree with one original text per file in plainly named folders, as collectors leave it.

    Creating a file costs far more than its few bytes, so the rows are spread over all cores first. In a mounted folder tasks
    create the files themselves: through Hadoop's committer each takes milliseconds, with several renames and a checksum file.
    """
    base = shared_folder(spark, "flat")
    texts = flat_texts(events)
    spread = texts.repartition(spark.sparkContext.defaultParallelism, "file_name")
    rows = spread.select("bank_dir", "channel_dir", "event_text")
    if top := tasks_open(spark, f"{base}/tree"):
        _create_files(rows, top)
        return f"{base}/tree"
    rows.write.option("maxRecordsPerFile", 1).partitionBy("bank_dir", "channel_dir").text(f"{base}/written")
    for row in texts.select("bank_dir", "channel_dir").distinct().collect():  # three banks of four channels
        bank, channel = row
        move_folder(spark, f"{base}/written/bank_dir={bank}/channel_dir={channel}", f"{base}/tree/{bank}/{channel}")
    return f"{base}/tree"


def _create_files(rows: DataFrame, top: str) -> None:
    """One file per row below ``top``. The rows of a task are in order, so a repeated task gives each file its text again."""
    suffix = TREE_SUFFIX

    def create(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, known = TaskContext.get(), 0, set()
        for batch in batches:
            for bank, channel, text in zip(*(batch[c].to_pylist() for c in ("bank_dir", "channel_dir", "event_text")), strict=True):
                if bank is None or channel is None:
                    raise OSError("an event without a bank or channel has no folder")
                folder = f"{top}/{bank}/{channel}"
                if folder not in known:
                    os.makedirs(folder, exist_ok=True)
                    known.add(folder)
                name = f"part-{task.partitionId():05d}-{count:09d}"
                hidden = f"{folder}/.{name}.{task.taskAttemptId()}"
                with open(hidden, "w", encoding="utf-8", newline="") as file:
                    file.write(f"{text or ''}\n")  # as Spark's text writer ends a row
                os.replace(hidden, f"{folder}/{name}{suffix}")
                count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    rows.sortWithinPartitions(*rows.columns).mapInArrow(create, "files LONG").agg(F.sum("files")).collect()
