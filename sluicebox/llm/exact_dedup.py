"""Exact dedup by content sort.

Texts are compared without the characters of ``BLANKS``. Sampled splitters range-partition the normalised bytes: the order is
that of their first ``HEAD`` bytes, then of their digest, so that splitters stay small and texts with one opening spread over
partitions. Copies of one text are ordered by length and identifier, so a large group of copies is cut by splitters, too. Each
partition is sorted externally (Spark's sort, which spills), equal texts lie side by side, and each text is compared in full
with its neighbour. A run that begins in one partition may go on in the next: first and last runs, two a partition at
most, are compared in a second step.

Of equal texts, the one with the most code points stays, then the one with the smallest doc_id, then the first in order.

Defined results: a null text is the empty text, and all texts without other characters are equal; a null doc_id comes last
in the order, and where its row stays, keep_id is null; of rows that repeat a doc_id and a text, exactly one is kept; no rows
give no rows. Other columns are ignored by ``copy_groups`` and kept by ``keep_distinct``. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicebox.llm.common import whole_text, written

BLANKS = r"[\x20\x09-\x0D]"
HEAD = 48
ADDED = [
    pa.field("leader", pa.int64()), pa.field("size", pa.int64()), pa.field("opening", pa.bool_()), pa.field("part", pa.int32()),
    pa.field("place", pa.int32()), pa.field("edge", pa.binary()),
]
ADDED_TYPES = "leader long, size long, opening boolean, part int, place int, edge binary"
INNER, FIRST, LAST = 0, 1, 2  # where in its partition a run lies; a run that is alone is a first one


def content_sorted(documents: DataFrame, carry: list[str]) -> DataFrame:
    """doc_id, raw (normalised bytes), digest and the carried columns as ``row``, partitioned and sorted by content."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.struct(F.lit(0).alias("__"), *carry).alias("row")
    )
    content = rows.select(
        "doc_id", "row", F.char_length("text").alias("points"), F.regexp_replace("text", BLANKS, "").cast("binary").alias("raw")
    )
    keyed = content.select("*", F.sha2("raw", 256).alias("digest"), F.substring("raw", 1, HEAD).alias("head"))
    longest = (F.desc("points"), F.asc_nulls_last("doc_id"))
    ranged = keyed.repartitionByRange("head", "digest", *longest)
    return ranged.sortWithinPartitions("head", "digest", "raw", *longest).select("doc_id", "raw", "digest", "row")


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with the first row of their run, and the run's size and place; first rows of outer runs carry its bytes.

    Rows of a run wait until it ends, without their bytes.
    """
    part = TaskContext.get().partitionId()
    waiting: list[pa.RecordBatch] = []  # of the open run
    text, leader, place = None, None, FIRST

    def closed(place: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        n = rows.num_rows
        opening = np.arange(n) == 0
        edge = pa.array([text.as_py()] + [None] * (n - 1), pa.binary()) if place != INNER else pa.nulls(n, pa.binary())
        columns = [
            rows["doc_id"], rows["digest"], rows["row"], pa.array([leader] * n, pa.int64()), pa.array(np.full(n, n)), pa.array(opening),
            pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, place, np.int32)), edge,
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    for batch in batches:
        raw = batch["raw"]
        rest = batch.select(["doc_id", "digest", "row"])
        differs = np.ones(batch.num_rows, bool)
        if batch.num_rows:
            differs[0] = text is None or raw[0].as_py() != text.as_py()
            differs[1:] = pc.not_equal(raw.slice(1), raw.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(differs)
        if not len(starts):
            waiting.append(rest)
            continue
        if starts[0]:
            waiting.append(rest.slice(0, starts[0]))
        if waiting:
            yield from closed(place).to_batches()
            place = INNER
        inner = starts[:-1]  # runs that begin and end in this batch
        if len(inner):
            sizes = np.diff(starts)
            if place == FIRST:  # the partition's first run is closed on its own
                text, leader, waiting = raw[inner[0]], rest["doc_id"][inner[0]].as_py(), [rest.slice(inner[0], sizes[0])]
                yield from closed(FIRST).to_batches()
                place, inner, sizes = INNER, inner[1:], sizes[1:]
        if len(inner):
            low, high = inner[0], starts[-1]
            rows = rest.slice(low, high - low)
            at = np.repeat(inner - low, sizes)
            columns = [
                rows["doc_id"], rows["digest"], rows["row"], rows["doc_id"].take(pa.array(at)), pa.array(np.repeat(sizes, sizes)),
                pa.array(differs[low:high]), pa.array(np.full(high - low, part, np.int32)),
                pa.array(np.full(high - low, INNER, np.int32)), pa.nulls(high - low, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        last = starts[-1]
        text, leader, waiting = raw[last], rest["doc_id"][last].as_py(), [rest.slice(last)]
    if waiting:
        yield from closed(LAST if place == INNER else FIRST).to_batches()


def grouped_copies(documents: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, and the carried columns as ``row``."""
    ordered = content_sorted(documents, carry or [])
    runs = T.StructType([ordered.schema[n] for n in ("doc_id", "digest", "row")] + T.StructType.fromDDL(ADDED_TYPES).fields)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            kept = [first.schema.field(n) for n in ("doc_id", "digest", "row")]
            yield from _runs(chain([first], batches), pa.schema(kept + ADDED))

    found = written(ordered.mapInArrow(find, runs), "copies")
    # At most two runs a partition have an edge, so neither these groups nor the broadcast grow with the rows.
    edges = found.where("edge is not null").groupBy("edge").agg(
        F.min(F.struct("part", "place", "leader")).alias("first"), F.sum("size").alias("whole"), F.collect_list(F.struct("part", "place")).alias("runs")
    )
    joined = edges.select("first", "whole", F.explode("runs").alias("run")).select(
        F.col("run.part").alias("part"), F.col("run.place").alias("place"), F.col("first.leader").alias("first_leader"), "whole",
        ((F.col("first.part") == F.col("run.part")) & (F.col("first.place") == F.col("run.place"))).alias("begins"),
    )
    rows = found.join(F.broadcast(joined), ["part", "place"], "left")
    outer = F.col("begins").isNotNull()
    return rows.select(
        "doc_id", F.when(outer, F.col("first_leader")).otherwise(F.col("leader")).alias("keep_id"),
        F.when(outer, F.col("whole")).otherwise(F.col("size")).alias("group_size"),
        (F.col("opening") & F.coalesce("begins", F.lit(True))).alias("kept"), F.col("digest").alias("text_sha256"), "row",
    )


def copy_groups(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256."""
    return grouped_copies(documents).drop("row")


def keep_distinct(documents: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = grouped_copies(documents, documents.columns).where("kept")
    return kept.select(*[F.col("row")[name].alias(name) for name in documents.columns])
