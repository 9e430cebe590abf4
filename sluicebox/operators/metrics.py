"""What a monitor shows about the layers. Everything is aggregated before it is combined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.quality import is_rejected


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row per layer; the counts of Parquet layers come from file footers."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        for name, frame in layers.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def health_rate(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Silver rows per hundred bronze rows; 100 while bronze is empty. Appended reruns can exceed 100."""

    def rows_of(layer: str) -> Column:
        return F.sum(F.when(F.col("layer") == layer, F.col("n"))).alias(f"total_{layer}")

    totals = layer_counts(bronze=bronze, silver=silver).agg(rows_of("bronze"), rows_of("silver"))
    share = F.col("total_silver") / F.col("total_bronze") * 100
    return totals.withColumn("health_rate", F.when(F.col("total_bronze") > 0, share).otherwise(F.lit(100.0)))


def percent_text(rate: float) -> str:
    """Display form. Done at the edge, because Spark and Python round ties differently."""
    return f"{rate:.1f}%"


def bank_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("bank_id").agg(F.count(F.lit(1)).alias("count"))


def bank_share(silver: DataFrame) -> DataFrame:
    """Each bank's part of all rows.

    The total is a scalar subquery over the per-bank counts, so their exchange is computed once and
    reused, and no window pulls all banks into one task.
    """
    per_bank = bank_distribution(silver)
    total = per_bank.agg(F.sum("count")).scalar()
    return per_bank.withColumn("share", F.col("count") / total)


def freshness(silver: DataFrame) -> DataFrame:
    """Latest processing time and its clock text; null and N/A on an empty layer."""
    latest = silver.agg(F.max("processed_at").alias("last_processed"))
    clock = F.coalesce(F.date_format("last_processed", "HH:mm:ss"), F.lit("N/A"))
    return latest.withColumn("last_pulse", clock)


def distinct_banks(silver: DataFrame) -> DataFrame:
    return silver.select("bank_id").distinct()


def of_banks(silver: DataFrame, banks: Sequence[str]) -> DataFrame:
    """Rows of the chosen banks; on a stored layer this prunes partitions. No bank gives no rows."""
    return silver.filter(F.col("bank_id").isin(list(banks)))


def first_rows(frame: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """At most ``n`` rows: any, or with an order the first (each partition keeps its own ``n`` only)."""
    return (frame.orderBy(*order_by) if order_by else frame).limit(n)


def masking_sample(silver: DataFrame, banks: Sequence[str], n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    shown = of_banks(silver, banks).select("transaction_id", "bank_id", "amount", "masked_card", "quality_score")
    return first_rows(shown, n, order_by)


def bank_summary(silver: DataFrame) -> DataFrame:
    """Rows and latest processing time per bank in one pass.

    Total, banks, distribution, shares and freshness of a monitor page all follow from these few rows.
    """
    return silver.groupBy("bank_id").agg(
        F.count(F.lit(1)).alias("count"), F.max("processed_at").alias("last_processed")
    )


def reject_rate(scored: DataFrame) -> list[Column]:
    """Aggregates for the share of rejected rows in a group of scored rows."""
    rejected = F.count_if(is_rejected())
    total = F.count(F.lit(1))
    return [total.alias("total"), rejected.alias("rejected"), (rejected / total).alias("reject_rate")]
