"""Explicit schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

from sluicebox.constants import FLAT_REQUIRED_FIELDS


def _struct(**fields: T.DataType | type[T.DataType]) -> T.StructType:
    """A struct of nullable fields; built without DDL text, which would need a running session."""
    return T.StructType([T.StructField(n, t() if isinstance(t, type) else t) for n, t in fields.items()])


KAFKA_SCHEMA = _struct(
    key=T.BinaryType,
    value=T.BinaryType,
    topic=T.StringType,
    partition=T.IntegerType,
    offset=T.LongType,
    timestamp=T.TimestampType,
)

BRONZE_SCHEMA = _struct(
    key=T.StringType,
    raw_payload=T.StringType,
    topic=T.StringType,
    partition=T.IntegerType,
    offset=T.LongType,
    ingest_time=T.TimestampType,
)

_METADATA = _struct(branch_id=T.StringType, device_status=T.StringType)

# The whole event as producers send it. Silver does not use every field, but all are parsed: when a
# text breaks inside a field, what was read before it is kept only if that field is asked for.
EVENT_SCHEMA = _struct(
    bank_id=T.StringType,
    channel=T.StringType,
    raw_payload=_struct(
        atmCode=T.StringType,
        trxAmt=T.StringType,
        trxTime=T.StringType,
        cardNumber=T.StringType,
        extra_field=T.IntegerType,
    ),
    ingest_time=T.StringType,
    source_event_id=T.StringType,
    extra_metadata=_METADATA,
)

SILVER_SCHEMA = _struct(
    transaction_id=T.StringType,
    event_timestamp=T.TimestampType,
    bank_id=T.StringType,
    channel=T.StringType,
    amount=T.DoubleType,
    masked_card=T.StringType,
    status=T.StringType,
    quality_score=T.StringType,
    processed_at=T.TimestampType,
)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()
SILVER_PARTITIONS = ["bank_id", "channel"]

# Flat events keep their JSON token types, so their fields are VARIANT. As members of a struct,
# an absent field is SQL NULL and an explicit JSON null is a variant null.
CORRUPT_TEXT = "_corrupt_text"
FLAT_EVENT_SCHEMA = _struct(
    **{name: T.VariantType for name in FLAT_REQUIRED_FIELDS}, **{CORRUPT_TEXT: T.StringType}
)


# Options under which times and texts in JSON and CSV come back as they were.
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
FAITHFUL_CSV = TEXT_TIMES | {
    "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "true",
}
