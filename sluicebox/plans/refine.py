"""Batch refinement: bronze to silver, garbage, the clean feed and the CSV export."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from sluicebox.functions.quality import COMPLETENESS, RuleSet
from sluicebox.operators.feed import clean_feed
from sluicebox.operators.routing import clean_rows, rejected_rows
from sluicebox.operators.silver import to_silver
from sluicebox.sinks.fan_out import Sink, SinkResult, fan_out, held
from sluicebox.sinks.files import write_csv, write_garbage, write_silver
from sluicebox.sinks.kafka import write_feed
from sluicebox.sources.layers import read_bronze


@dataclass(frozen=True)
class Targets:
    """Where the outputs go. Feed and CSV are left out when not named."""

    silver: str
    garbage: str
    feed_servers: str | None = None
    csv: str | None = None
    csv_single_file: bool = False


def run_refine(
    spark: SparkSession,
    bronze_path: str,
    targets: Targets,
    as_of: datetime | str | None = None,
    rules: RuleSet = COMPLETENESS,
    hold: str = "table",
    layout: str = "rebalance",
) -> list[SinkResult]:
    """One run over all of bronze. Silver and garbage are appended to, so a second run doubles them.

    All sinks see one processing time, fixed before the first of them starts. The feed is optional by
    nature: when the broker is away, the files are still written.
    """
    now = as_of or datetime.now(timezone.utc)
    scored = to_silver(read_bronze(spark, bronze_path), now, rules)
    sinks = [
        Sink("silver", lambda frame: write_silver(clean_rows(frame), targets.silver, layout=layout)),
        Sink("garbage", lambda frame: write_garbage(rejected_rows(frame), targets.garbage)),
    ]
    if targets.feed_servers:
        servers = targets.feed_servers
        sinks.append(Sink("feed", lambda frame: write_feed(clean_feed(frame), servers), required=False))
    if targets.csv:
        path = targets.csv
        sinks.append(Sink("csv", lambda frame: write_csv(clean_rows(frame), path, targets.csv_single_file)))
    with held(scored, hold) as frame:
        return fan_out(frame, sinks)
