"""Hourly states of silver that merge into longer periods: rows, amounts, distinct cards, quantiles of amounts.

Silver is scanned once, for the hours. Days, months and banks as a whole are merged from what was stored, some kilobytes per hour, bank
and channel, and so are hours that several batches have seen. Both sketches pre-aggregate in tasks, so a bank with most rows costs the
shuffle one state per hour and task.

Errors. Distinct cards: relative standard error of 1.04 / sqrt(2 ** CARDS_LOG2), 1.6 % at 12, whatever was merged. Quantiles: the rank of
a returned amount is within 1.7 % of the one asked for with a probability of 99 % (``AMOUNTS_K`` of 200).

Null cards are no card, and null or NaN amounts have no rank: periods without any amount have null quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.values import exact_amount, other_amount, whole_sum

CARDS_LOG2 = 12
AMOUNTS_K = 200
STATE_KEYS = ("window_start", "bank_id", "channel")


def hourly_states(silver: DataFrame) -> DataFrame:
    """One mergeable state per hour, bank and channel."""
    ranked = F.when(~F.isnan("amount"), F.col("amount"))
    rows = silver.withColumn("window_start", F.date_trunc("hour", "event_timestamp"))
    return rows.groupBy(*STATE_KEYS).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(exact_amount(F.col("amount"))).alias("exact"),
        F.sum(other_amount(F.col("amount"))).alias("other"),
        F.count(ranked).alias("ranked"),
        F.hll_sketch_agg("masked_card", CARDS_LOG2).alias("cards"),
        F.kll_sketch_agg_double(ranked, AMOUNTS_K).alias("amounts"),
    )


def merged_states(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """States of the same columns per group of ``keys``; merging merged states gives the same figures within the errors."""
    return states.groupBy(*keys).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("exact").alias("exact"),
        F.sum("other").alias("other"),
        F.sum("ranked").alias("ranked"),
        F.hll_union_agg("cards").alias("cards"),
        F.kll_merge_agg_double("amounts", AMOUNTS_K).alias("amounts"),
    )


def per_period(states: DataFrame, period: str, *keys: str) -> DataFrame:
    """States per ``period`` (a unit of ``date_trunc`` from the hour up) and the other ``keys``."""
    return merged_states(states, [F.date_trunc(period, "window_start").alias("window_start"), *keys])


def figures(states: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """What the states tell: rows, total amount, distinct cards, and the amount at each of the ``quantiles``."""
    state = ("txn_count", "exact", "other", "ranked", "cards", "amounts")
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    return states.select(
        *[c for c in states.columns if c not in state],
        "txn_count",
        whole_sum(F.col("exact"), F.col("other")).alias("total_amount"),
        F.hll_sketch_estimate("cards").alias("distinct_cards"),
        F.when(F.col("ranked") > 0, F.kll_sketch_get_quantile_double("amounts", at)).alias("amount_quantiles"),
    )
