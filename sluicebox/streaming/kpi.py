"""Windowed aggregates of a silver stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicebox.operators.gold import kpi_window
from sluicebox.streaming.ingest import ALL_AVAILABLE


def dated(silver: DataFrame) -> DataFrame:
    return silver.filter(~F.equal_null("event_timestamp", "processed_at"))


def start_undated(silver: DataFrame, path: str, checkpoint: str, trigger: dict = ALL_AVAILABLE) -> StreamingQuery:
    """Append the rows that have no time of their own, so that counts of windows and of these add up to all rows."""
    rows = silver.filter(F.equal_null("event_timestamp", "processed_at"))
    writer = rows.writeStream.outputMode("append").trigger(**trigger).queryName("undated")
    return writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()


def start_kpi(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    lateness: str = "2 days",
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Append a window's rows once the watermark has passed its end; state is one row per open window.

    A row whose time was unreadable carries the processing time. It belongs to no known window and must not move the
    watermark, or true rows would count as late: such rows are left to ``start_undated``.
    """
    windows = kpi_window(dated(silver).withWatermark("event_timestamp", lateness), width)
    writer = windows.writeStream.outputMode("append").trigger(**trigger).queryName("kpi")
    return writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
