"""Kafka writers. They need the spark-sql-kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluicebox.constants import CLEAN_FEED_TOPIC


def write_feed(feed: DataFrame, servers: str, topic: str = CLEAN_FEED_TOPIC) -> None:
    """Key/value records to one topic."""
    feed.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_by_topic(records: DataFrame, servers: str) -> None:
    """Records to the topic each row names, all topics in one job."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
