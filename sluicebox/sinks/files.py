"""File writers.

A partitioned write without a shuffle makes up to one file per task and partition: at 100,000 tasks
and a dozen partitions, over a million small files. ``layout="rebalance"`` shuffles the (already narrow)
rows by partition first; adaptive execution then joins small parts and splits hot ones to the advisory
size, so a bank that holds a third of all rows is written by many tasks. ``layout="as_is"`` skips that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.constants import FLAT_REQUIRED_FIELDS
from sluicebox.operators.metrics import of_banks
from sluicebox.schemas import FAITHFUL_CSV, SILVER_COLUMNS, SILVER_PARTITIONS, TEXT_TIMES


def laid_out(frame: DataFrame, keys: Sequence[str], layout: str) -> DataFrame:
    if layout == "as_is":
        return frame
    if layout == "rebalance":
        # Without adaptive execution the hint is a plain hash shuffle: one task per partition, however hot.
        if frame.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("layout 'rebalance' needs spark.sql.adaptive.enabled; use 'as_is' without it")
        return frame.hint("rebalance", *keys)
    raise ValueError(f"unknown layout {layout!r}: use 'rebalance' or 'as_is'")


def write_silver(clean: DataFrame, path: str, mode: str = "append", layout: str = "rebalance") -> None:
    laid_out(clean, SILVER_PARTITIONS, layout).write.mode(mode).partitionBy(*SILVER_PARTITIONS).parquet(path)


def write_garbage(rejected: DataFrame, path: str, mode: str = "append", layout: str = "rebalance") -> None:
    rows = laid_out(rejected.select(*SILVER_COLUMNS), [], layout)
    rows.write.mode(mode).options(**TEXT_TIMES).json(path)


def write_csv(frame: DataFrame, path: str, single_file: bool = False, plain: bool = False) -> None:
    """Headed CSV that replaces the previous one. Blanks, quotes, line breaks and microseconds survive.

    By default every task writes its own headed file. ``single_file`` is for results known to be small:
    it sends all rows through one task. ``plain`` keeps Spark's own defaults, which trim texts and escape quotes by
    a backslash.
    """
    options = {"header": "true"} if plain else FAITHFUL_CSV
    (frame.coalesce(1) if single_file else frame).write.mode("overwrite").options(**options).csv(path)


def export_banks_csv(
    silver: DataFrame, banks: Sequence[str], folder: str, at: datetime, single_file: bool = False
) -> str:
    """Silver rows of the chosen banks as CSV, named after the minute of the export."""
    path = f"{folder.rstrip('/')}/cleaned_batch_{at:%Y%m%d_%H%M}.csv"
    write_csv(of_banks(silver, banks), path, single_file)
    return path


def run_name(at: datetime | None = None) -> str:
    """A name that sorts by time and never repeats."""
    return f"{at or datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def _add_run(frame: DataFrame, keys: Sequence[str], path: str, layout: str, run: str | None) -> None:
    """A run writes a folder of its own and touches no other, so a run that dies leaves earlier events as they were."""
    folder = f"{path.rstrip('/')}/run={run or run_name()}"
    laid_out(frame, keys, layout).write.mode("overwrite").partitionBy(*keys).json(folder)


def write_flat_silver(canonical_rows: DataFrame, path: str, layout: str = "rebalance", run: str | None = None) -> None:
    """Canonical events as JSON lines per run, bank and channel folder. The file's name stands beside the document."""
    named = canonical_rows.select("bank_dir", "channel_dir", "file_name", F.struct(*FLAT_REQUIRED_FIELDS).alias("event"))
    _add_run(named, ["bank_dir", "channel_dir"], path, layout, run)


def write_flat_garbage(issue_rows: DataFrame, path: str, layout: str = "rebalance", run: str | None = None) -> None:
    """Texts of rejected events as JSON lines per run, bank, channel and issue."""
    _add_run(issue_rows, ["bank_dir", "channel_dir", "issue"], path, layout, run)
