"""Bronze rows to scored silver rows: one narrow stage, no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicebox.functions.once import computed_once
from sluicebox.functions.quality import COMPLETENESS, RuleSet
from sluicebox.functions.values import amount_of, card_digest, event_time_of, instant
from sluicebox.schemas import EVENT_SCHEMA, SILVER_COLUMNS

# Where each flattened column comes from inside the parsed event.
EVENT_PATHS = {
    "transaction_id": "source_event_id",
    "bank_id": "bank_id",
    "channel": "channel",
    "raw_amount": "raw_payload.trxAmt",
    "raw_time": "raw_payload.trxTime",
    "card_number": "raw_payload.cardNumber",
    "status": "extra_metadata.device_status",
    "location": "extra_metadata.branch_id",
}


def parse_events(bronze: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Append the parsed event as struct ``data``; text that does not parse gives nulls, not errors."""
    return bronze.withColumn("data", F.from_json("raw_payload", schema))


def flatten(parsed: DataFrame) -> DataFrame:
    """One column per event field, with the amount typed and the broker's time carried along."""
    fields = [
        amount_of(F.col(f"data.{path}")).alias("amount") if name == "raw_amount" else F.col(f"data.{path}").alias(name)
        for name, path in EVENT_PATHS.items()
    ]
    return parsed.select(*fields, "ingest_time")


def parse_once(bronze: DataFrame) -> DataFrame:
    """``flatten(parse_events(bronze))``, parsing each text just once whatever is filtered afterwards."""
    return flatten(computed_once(bronze, "data", F.from_json("raw_payload", EVENT_SCHEMA)))


def add_quality(flat: DataFrame, rules: RuleSet = COMPLETENESS) -> DataFrame:
    return flat.withColumn("quality_score", rules.score())


def refine(flat: DataFrame, as_of: datetime | str | Column | None = None, rules: RuleSet = COMPLETENESS) -> DataFrame:
    """Score, mask and time-stamp flattened rows; raw card, raw time and location are left behind."""
    now = instant(as_of)
    derived = {
        "masked_card": card_digest(F.col("card_number")),
        "event_timestamp": event_time_of(F.col("raw_time"), now),
        "processed_at": now,
    }
    return add_quality(flat, rules).withColumns(derived).select(*SILVER_COLUMNS)


def to_silver(bronze: DataFrame, as_of: datetime | str | Column | None = None, rules: RuleSet = COMPLETENESS) -> DataFrame:
    """All bronze rows, clean or not, in the silver layout."""
    return refine(parse_once(bronze), as_of, rules)
