"""Averages in which older amounts count less, per card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
BUCKET_HALF_LIVES = 8
SUPER_HALF_LIVES = 512  # what is older than that counts less than 2 ** -512 and is left out
GREATEST = 1e100  # times 2 ** 520 it is still a double


def decayed_averages(silver: DataFrame, half_life_seconds: int = 3600) -> DataFrame:
    """Per card and instant: transactions, decayed number of transactions and decayed average amount up to that instant.

    An amount of age a counts 2 ** (-a / half life); the average is the sum of such amounts over the sum of their shares. Both
    sums at an instant are those at any earlier one, shrunk by the time between, and what came since. So they are computed in
    three steps, none of which sees a whole card: sums from the start of a bucket of eight half-lives on; the sums that each
    bucket hands on, from those of the earlier buckets of up to ``SUPER_HALF_LIVES``; and both together. Shares are powers
    relative to the start of a bucket, small enough for doubles.

    Rows without a card, and amounts that are null, NaN, infinite or beyond ``GREATEST`` in size take no part; an instant that has
    others only has no row.
    """
    life = half_life_seconds * MICROS
    bucket, above = BUCKET_HALF_LIVES * life, SUPER_HALF_LIVES * life
    amount = F.col("amount")
    at = F.col("at")
    instants = (
        silver.filter(F.col("masked_card").isNotNull() & (F.abs(amount) <= GREATEST))
        .groupBy("masked_card", "event_timestamp")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(amount.cast("double")).alias("s"))
        .withColumn("at", F.unix_micros("event_timestamp"))
        .withColumn("bucket", at - F.pmod(at, F.lit(bucket)))
    )

    def share(micros: Column) -> Column:
        return F.pow(F.lit(2.0), micros / F.lit(float(life)))

    since = share(at - F.col("bucket"))
    so_far = Window.partitionBy("masked_card", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    local = instants.select(
        "*", (F.sum(F.col("n") * since).over(so_far) / since).alias("n_local"), (F.sum(F.col("s") * since).over(so_far) / since).alias("s_local")
    )

    # What a bucket hands on, as of its end; and to each bucket, what all earlier ones handed on, as of its start.
    to_end = share(at - F.col("bucket") - bucket)
    totals = instants.groupBy("masked_card", "bucket").agg(F.sum(F.col("n") * to_end).alias("n_end"), F.sum(F.col("s") * to_end).alias("s_end"))
    home = F.col("bucket") - F.pmod("bucket", F.lit(above))
    spread = totals.select("*", home.alias("home"), F.explode(F.array(home, home + F.lit(above))).alias("super"))
    before = Window.partitionBy("masked_card", "super").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    from_super = F.col("bucket") - F.col("super")  # negative for the buckets of the part before
    handed = spread.select(
        "masked_card", "bucket", "home", "super",
        *[(F.sum(F.col(c) * share(from_super + bucket)).over(before) / share(from_super)).alias(c) for c in ("n_end", "s_end")],
    ).filter("home = super").drop("home", "super")
    rows = local.join(handed, ["masked_card", "bucket"])
    n = F.col("n_local") + F.coalesce("n_end", F.lit(0.0)) / since
    s = F.col("s_local") + F.coalesce("s_end", F.lit(0.0)) / since
    return rows.select("masked_card", "event_timestamp", F.col("n").alias("txn_count"), n.alias("decayed_count"), (s / n).alias("decayed_average"))
