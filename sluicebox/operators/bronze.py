"""Kafka-shaped records to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.constants import TOPIC_PATTERN


def matching_topics(records: DataFrame, pattern: str = TOPIC_PATTERN) -> DataFrame:
    """Records whose whole topic name matches, as a Kafka pattern subscription would deliver them."""
    return records.filter(F.col("topic").rlike(rf"\A(?:{pattern})\z"))


def to_bronze(records: DataFrame) -> DataFrame:
    """Text of key and value plus the broker's metadata; the payload itself stays unparsed."""
    return records.select(
        F.col("key").cast("string"),
        F.col("value").cast("string").alias("raw_payload"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ingest_time"),
    )
