"""Streams in which a record may come again, and layers that hold it once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicebox.streaming.ingest import ALL_AVAILABLE

RECORD = ("topic", "partition", "offset")


def without_repeats(rows: DataFrame, keys: Sequence[str] = RECORD, time: str = "ingest_time", within: str = "1 day") -> DataFrame:
    """The first row of each key; later ones go as long as they come within the given time.

    A key is remembered until the watermark passes the time of its first row by ``within``; state is one entry per key of that
    span. What that means for rows that come late: a row older than the watermark (the latest time seen, less ``within``) is dropped
    whether or not it is a repeat, as it can no longer be told; a repeat with a time more than ``within`` after that of the first
    row is taken for a new row. So ``within`` has to cover both the longest replay and the disorder of the input. Rows whose keys or
    time are null are no records of a broker; they cannot be told apart, and each passes once it has a time, or is dropped without one.
    """
    known = [F.col(k).isNotNull() for k in keys]
    complete = known[0]
    for column in known[1:]:
        complete = complete & column
    # A key of its own keeps rows with null keys from being taken for one another.
    own = F.when(~complete, F.uuid())
    told = rows.withWatermark(time, within).withColumn("__own", own)
    return told.dropDuplicatesWithinWatermark([*keys, "__own"]).drop("__own")


def start_without_repeats(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = RECORD,
    time: str = "ingest_time",
    within: str = "1 day",
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Append first rows to Parquet. With the same checkpoint, a replay of the input adds no row, also after a restart."""
    writer = without_repeats(rows, keys, time, within).writeStream.outputMode("append").trigger(**trigger).queryName("without-repeats")
    return writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
