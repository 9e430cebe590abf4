"""Kafka readers. They need the spark-sql-kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicebox.constants import TOPIC_PATTERN


def kafka_options(
    servers: str,
    pattern: str = TOPIC_PATTERN,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options.

    ``max_offsets_per_trigger`` bounds a batch when a stream starts on a long backlog, and
    ``min_partitions`` splits hot Kafka partitions into more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": pattern,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | extra


def stream_topics(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Unbounded records of every topic that matches the pattern, new topics included."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, **options)).load()
