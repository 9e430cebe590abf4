"""The monitor's figures over stored layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.operators.metrics import bank_summary, layer_counts
from sluicebox.sources.layers import read_garbage_if_any, read_required


@dataclass(frozen=True)
class Report:
    """``figures`` is one row; ``banks`` has one row per bank with its count and share."""

    figures: DataFrame
    banks: DataFrame


def build_report(spark: SparkSession, bronze_path: str, silver_path: str, garbage_path: str) -> Report:
    """One aggregation per layer answers everything; silver is read for bank and time only."""
    bronze, silver = read_required(spark, bronze_path, silver_path)
    garbage = read_garbage_if_any(spark, garbage_path)

    summary = bank_summary(silver)
    total = F.sum("count")
    silver_figures = summary.agg(
        F.coalesce(total, F.lit(0)).alias("total_silver"),
        F.count(F.lit(1)).alias("active_banks"),
        F.max("last_processed").alias("last_processed"),
    )
    others = layer_counts(bronze=bronze, garbage=garbage)

    def rows_of(layer: str):
        return others.filter(F.col("layer") == layer).select("n").scalar()

    counted = silver_figures.select(
        rows_of("bronze").alias("total_bronze"), "total_silver", rows_of("garbage").alias("total_garbage"),
        "active_banks", "last_processed",
    )
    rate = F.when(
        F.col("total_bronze") > 0, F.col("total_silver") / F.col("total_bronze") * 100
    ).otherwise(F.lit(100.0))
    pulse = F.coalesce(F.date_format("last_processed", "HH:mm:ss"), F.lit("N/A"))
    figures = counted.withColumns({"health_rate": rate, "last_pulse": pulse})

    banks = summary.select("bank_id", "count", (F.col("count") / summary.agg(total).scalar()).alias("share"))
    return Report(figures, banks)
