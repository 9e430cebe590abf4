"""Runs of neighbouring rows, where no task sees a whole key: card sessions, incidents of rejects, gaps in offsets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.functions.values import exact_amount, other_amount, whole_sum
from sluicebox.operators.gold import garbage_alert

Measures = dict[str, Callable[[str], Column]]
MICROS = 1_000_000


def join_runs(points: DataFrame, keys: Sequence[str], gap: int, widths: Sequence[int], measures: Measures) -> DataFrame:
    """The keys, ``first``, ``last`` and combined measures of each longest run whose neighbours are at most ``gap`` apart.

    ``points`` hold one row per key and place: equal longs ``first`` and ``last``, and the measures. Any key may hold most
    rows. So runs are formed within buckets of the first width; of each bucket, only its first and its last run can go on
    elsewhere, and only these are joined in buckets of the next width, and at last over the whole key. The last step thus sees
    two rows per widest bucket, however many points there are. A null key is a key of its own.
    """
    runs, parts = points.select(*keys, "first", "last", *measures), []
    for width in widths:
        joined = _joined(runs, keys, gap, width, measures)
        parts.append(joined.filter(~F.col("__open")))
        runs = joined.filter("__open").drop("__open")
    parts.append(_joined(runs, keys, gap, None, measures))
    return reduce(DataFrame.unionByName, parts).drop("__open")


def _joined(runs: DataFrame, keys: Sequence[str], gap: int, width: int | None, measures: Measures) -> DataFrame:
    """Runs joined within buckets (or keys, without a width), and whether they lie at an edge of their bucket."""
    place = F.col("first")
    bucket = F.lit(0).cast("bigint") if width is None else place - F.pmod(place, F.lit(width))
    inside = Window.partitionBy(*keys, "__bucket")
    ordered = inside.orderBy("first")
    starts = F.coalesce(place - F.lag("last").over(ordered) > gap, F.lit(True))
    marked = runs.withColumn("__bucket", bucket).withColumn("__starts", starts.cast("bigint"))
    numbered = marked.withColumn("__run", F.sum("__starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(*keys, "__bucket", "__run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), *[combine(name).alias(name) for name, combine in measures.items()]
    )
    at_edge = (F.col("__run") == 1) | (F.col("__run") == F.max("__run").over(inside))
    return joined.withColumn("__open", at_edge).drop("__bucket", "__run")


def card_sessions(silver: DataFrame, gap_seconds: int = 1800, bucket_seconds: int = 86_400) -> DataFrame:
    """Per card: spans of transactions that follow each other within the gap, with their number and amount.

    Rows are first reduced to one per card and instant. Rows without a card have no session.
    """
    amount = F.col("amount")
    instants = (
        silver.filter(F.col("masked_card").isNotNull())
        .groupBy("masked_card", F.unix_micros("event_timestamp").alias("first"))
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum(exact_amount(amount)).alias("exact"), F.sum(other_amount(amount)).alias("other"))
    )
    measures = {name: F.sum for name in ("txn_count", "exact", "other")}
    sessions = join_runs(
        instants.withColumn("last", F.col("first")), ["masked_card"], gap_seconds * MICROS, [bucket_seconds * MICROS], measures
    )
    return sessions.select(
        "masked_card", F.timestamp_micros("first").alias("session_start"), F.timestamp_micros("last").alias("session_end"), "txn_count",
        whole_sum(F.col("exact"), F.col("other")).alias("total_amount"),
    )


def garbage_incidents(
    scored: DataFrame, threshold: float, width_seconds: int = 3600, quiet_windows: int = 0, bucket_windows: int = 24
) -> DataFrame:
    """Runs of alerting windows as incidents: start, end, windows, rows, rejected rows and the highest reject rate.

    Up to ``quiet_windows`` windows in between that do not alert, or have no rows, do not end an incident.
    """
    alerts = garbage_alert(scored, threshold, f"{width_seconds} seconds")
    start = F.unix_micros("window_start")
    points = alerts.select(
        start.alias("first"), start.alias("last"), F.lit(1).cast("bigint").alias("windows"), "total", "rejected", F.col("reject_rate").alias("peak_rate")
    )
    width = width_seconds * MICROS
    measures: Measures = {"windows": F.sum, "total": F.sum, "rejected": F.sum, "peak_rate": F.max}
    # The second width makes the last step, which is one task, see two rows per some thousand buckets.
    widths = [width * bucket_windows, width * bucket_windows * 4096]
    incidents = join_runs(points, [], width * (1 + quiet_windows), widths, measures)
    return incidents.select(
        F.timestamp_micros("first").alias("incident_start"), F.timestamp_micros(F.col("last") + width).alias("incident_end"),
        "windows", "total", "rejected", "peak_rate",
    )


def offset_audit(bronze: DataFrame, width: int = 1_000_000) -> DataFrame:
    """What is wrong with the offsets of each topic and partition: missing ranges, and offsets that are there repeatedly.

    ``kind`` is ``missing`` (``records`` offsets from ``first_offset`` to ``last_offset`` are absent, though lower and higher ones
    are there) or ``repeated`` (``records`` copies too many). Gaps are found within ranges of ``width`` offsets, so that a hot
    partition is shared by many tasks; a second pass sees one row per range and settles what lies between them. Rows without an
    offset are left out. Transactional topics have offsets without a record: their control marks show as missing.
    """
    keys = ["topic", "partition"]
    present = bronze.filter(F.col("offset").isNotNull()).groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("copies"))
    ranged = present.withColumn("range", F.col("offset") - F.pmod("offset", F.lit(width)))
    repeated = present.filter("copies > 1").select(
        *keys, F.lit("repeated").alias("kind"), F.col("offset").alias("first_offset"), F.col("offset").alias("last_offset"),
        (F.col("copies") - 1).alias("records"),
    )
    inside = Window.partitionBy(*keys, "range").orderBy("offset")
    within = ranged.select(*keys, F.lag("offset").over(inside).alias("before"), F.col("offset").alias("after"))
    edges = ranged.groupBy(*keys, "range").agg(F.min("offset").alias("after"), F.max("offset").alias("highest"))
    over = Window.partitionBy(*keys).orderBy("range")
    between = edges.select(*keys, F.lag("highest").over(over).alias("before"), "after")
    missing = within.unionAll(between).filter(F.col("after") - F.col("before") > 1).select(
        *keys, F.lit("missing").alias("kind"), (F.col("before") + 1).alias("first_offset"), (F.col("after") - 1).alias("last_offset"),
        (F.col("after") - F.col("before") - 1).alias("records"),
    )
    return missing.unionAll(repeated)
