"""Key/value frames for Kafka."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.values import instant, topic_name, utc_iso_text
from sluicebox.operators.routing import clean_rows


def clean_feed(scored: DataFrame) -> DataFrame:
    """Clean rows as JSON, keyed by transaction; null fields are left out of the text."""
    clean = clean_rows(scored)
    value = F.to_json(F.struct(*clean.columns))
    return clean.select(F.col("transaction_id").cast("string").alias("key"), value.alias("value"))


def _published(events: DataFrame, as_of: datetime | str | Column | None, topic: str | Column | None) -> DataFrame:
    if topic is None:
        topic = topic_name(F.col("bank_id"), F.col("channel"))
    named = F.lit(topic) if isinstance(topic, str) else topic
    stamped = events.withColumn("event_timestamp", utc_iso_text(instant(as_of)))
    return stamped.select(named.alias("topic"), F.to_json(F.struct(*stamped.columns)).alias("value"))


def publish_frame(
    events: DataFrame, as_of: datetime | str | Column | None = None, topic: str | Column | None = None
) -> DataFrame:
    """Keyless JSON records of structured events for the Kafka writer.

    A producer that knows its topic names it; else it follows from the event's bank and channel. The moment of
    publishing is added to the event as ``event_timestamp``. Events without a topic are in ``unroutable``: a single one
    would fail the whole write.
    """
    return _published(events, as_of, topic).filter(F.col("topic").isNotNull())


def unroutable(
    events: DataFrame, as_of: datetime | str | Column | None = None, topic: str | Column | None = None
) -> DataFrame:
    """The records that ``publish_frame`` cannot send, as they have no topic."""
    return _published(events, as_of, topic).filter(F.col("topic").isNull()).select("value")
