"""Aggregates on top of silver: volume per time window, card velocity, reject alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.functions.values import exact_amount, other_amount, whole_sum
from sluicebox.operators.metrics import reject_rate


def kpi_window(silver: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows and amount per time window, bank and channel. Works on batch and on watermarked streams.

    Every amount is in its sum: exact ones by decimals, the others (NaN, infinities, 1e12 and more) as doubles would add.

    Tasks pre-aggregate, so a bank that holds most rows costs the shuffle one row per window and task.
    """
    window = F.window("event_timestamp", width, slide) if slide else F.window("event_timestamp", width)
    grouped = silver.groupBy(window.alias("w"), "bank_id", "channel").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(exact_amount(F.col("amount"))).alias("exact"),
        F.sum(other_amount(F.col("amount"))).alias("other"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "bank_id",
        "channel",
        "txn_count",
        whole_sum(F.col("exact"), F.col("other")).alias("total_amount"),
    )


def velocity(silver: DataFrame, span_seconds: int = 3600) -> DataFrame:
    """Per card and instant: transactions and average amount over the span that ends there.

    Any card may hold most rows, so no task may see a whole card. Rows are first reduced to one per card
    and instant; these go to buckets of one span each, and the next bucket gets a copy as look-back.
    Silver times have whole seconds (but for the fallback time), so a bucket of a card has at most about
    two rows per second of the span, however many transactions there are. Rolling sums are
    differences of two running sums: both frames only grow, and decimals subtract exactly. Amounts that
    decimals cannot hold (NaN, infinities, 1e12 and more) cannot be subtracted again; buckets that have any add them
    per span.
    """
    span = span_seconds * 1_000_000
    exact, other = exact_amount(F.col("amount")), other_amount(F.col("amount"))
    instants = (
        silver.filter(F.col("masked_card").isNotNull())
        .groupBy("masked_card", "event_timestamp")
        .agg(F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_amount"), F.sum(exact).alias("s_exact"), F.sum(other).alias("s_other"))
    )
    at = F.unix_micros("event_timestamp")
    home = at - F.pmod(at, F.lit(span))  # start of the bucket
    spread = instants.select(
        "*", at.alias("at"), home.alias("home"), F.explode(F.array(home, home + F.lit(span))).alias("bucket")
    )

    by_card = Window.partitionBy("masked_card", "bucket").orderBy("at")
    until_now = by_card.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before_span = by_card.rangeBetween(Window.unboundedPreceding, -span - 1)

    def rolling(column: str):
        return F.sum(column).over(until_now) - F.coalesce(F.sum(column).over(before_span), F.lit(0))

    def spans(rows: DataFrame, other_sum: Column) -> DataFrame:
        return rows.select(
            "masked_card",
            "event_timestamp",
            "home",
            "bucket",
            F.col("n").alias("txn_count"),
            rolling("n").alias("txn_count_span"),
            rolling("n_amount").alias("amount_count_span"),
            rolling("s_exact").alias("exact_span"),
            other_sum.alias("other_span"),
        )

    in_bucket = Window.partitionBy("masked_card", "bucket")
    marked = spread.withColumn("others", F.count("s_other").over(in_bucket))
    in_span = by_card.rangeBetween(-span, Window.currentRow)
    rolled = spans(marked.filter("others = 0"), F.lit(None).cast("double")).unionAll(
        spans(marked.filter("others > 0"), F.sum("s_other").over(in_span))
    ).filter(F.col("home") == F.col("bucket"))
    average = whole_sum(F.col("exact_span"), F.col("other_span")) / F.nullif(F.col("amount_count_span"), F.lit(0))
    return rolled.select(
        "masked_card", "event_timestamp", "txn_count", "txn_count_span", average.alias("avg_amount_span")
    )


def garbage_alert(scored: DataFrame, threshold: float, width: str = "1 hour") -> DataFrame:
    """Time windows whose share of rejected rows is above the threshold (scored rows before routing)."""
    grouped = scored.groupBy(F.window("event_timestamp", width).alias("w")).agg(*reject_rate(scored))
    return grouped.filter(F.col("reject_rate") > threshold).select(
        F.col("w.start").alias("window_start"), "total", "rejected", "reject_rate"
    )
