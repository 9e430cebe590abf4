"""Splitting scored rows: every row goes to exactly one side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.quality import is_clean, is_rejected


def clean_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(is_clean())


def rejected_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(is_rejected())


def route_counts(scored: DataFrame) -> DataFrame:
    """Rows per route and label."""
    route = F.when(is_clean(), F.lit("silver")).otherwise(F.lit("garbage"))
    return scored.groupBy(route.alias("route"), "quality_score").agg(F.count(F.lit(1)).alias("n"))
