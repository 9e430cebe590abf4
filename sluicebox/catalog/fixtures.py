"""Event records derived row by row from the ``events`` table.

Dirt follows from ``event_id``, so SQL can state the expected silver rows from ``events`` alone, without
any JSON. All functions are narrow: they grow with the table and never shuffle it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.constants import CLEAN_FEED_TOPIC
from sluicebox.functions.values import topic_name

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

AS_OF = "2024-02-01 00:00:00"
MALFORMED = "{not json"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def customers_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``customer`` in the shape of ``events``, for the tree that needs one file per event."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return customer.select(
        F.col("c_custkey").alias("event_id"),
        (start + F.make_dt_interval(mins=F.col("c_custkey").cast("int"))).alias("ts"),
        F.col("c_nationkey").cast("bigint").alias("user_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )


def _mod(n: int) -> Column:
    return F.col("event_id") % n


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _bank_letter() -> Column:
    return F.substring(F.lit("ABC"), (F.col("user_id") % 3 + 1).cast("int"), F.lit(1))


def _channel() -> Column:
    names = F.array(*[F.lit(c) for c in ("ATM", "POS", "WEB", "MOBILE")])
    return F.element_at(names, (_mod(4) + 1).cast("int"))


def nested_event() -> dict[str, Column]:
    """The event a producer would send; a null member is absent from its JSON."""
    value = F.col("value").cast("string")
    amount = (
        F.when(_mod(10) == 3, F.lit(None)).when(_mod(10) == 7, "N/A").when(_mod(10) == 9, F.concat(F.lit("-"), value))
        .otherwise(value)
    )
    time = (
        F.when(_mod(50) == 8, "garbage").when(_mod(2) == 0, F.date_format("ts", "dd/MM/yy HH:mm"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    payload = F.struct(
        _text("A", _mod(50)).alias("atmCode"),
        amount.alias("trxAmt"),
        time.alias("trxTime"),
        F.when(_mod(30) != 1, _text("****", F.col("user_id") + 1000)).alias("cardNumber"),
        F.when(_mod(40) == 17, _mod(100).cast("int")).alias("extra_field"),
    )
    status = F.when(F.col("event_type") == "error", "WARN").otherwise("OK")
    metadata = F.struct(_text("B", _mod(20)).alias("branch_id"), status.alias("device_status"))
    return {
        "bank_id": F.when(_mod(20) != 5, F.concat(F.lit("BANK_"), _bank_letter())),
        "channel": _channel(),
        "raw_payload": payload,
        "ingest_time": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "source_event_id": _text("E", F.col("event_id")),
        "extra_metadata": F.when(_mod(15) != 4, metadata),
    }


def structured_events(events: DataFrame) -> DataFrame:
    """Events as columns, before they are published."""
    return events.select(*[column.alias(name) for name, column in nested_event().items()])


def _kafka_row(events: DataFrame, topic: Column) -> DataFrame:
    text = F.to_json(F.struct(*[column.alias(name) for name, column in nested_event().items()]))
    value = F.when(_mod(25) == 6, F.lit(MALFORMED)).otherwise(text)
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        topic.alias("topic"),
        _mod(3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _input_topic() -> Column:
    return topic_name(F.concat(F.lit("BANK_"), _bank_letter()), _channel())


def kafka_records(events: DataFrame) -> DataFrame:
    """One broker record per event on its input topic."""
    return _kafka_row(events, _input_topic())


def kafka_with_other_topics(events: DataFrame) -> DataFrame:
    """The records above among others that a subscription must not take: the clean feed and near misses."""
    decoy = (
        F.when(F.col("event_type") == "signup", F.lit(CLEAN_FEED_TOPIC))
        .when(F.col("event_type") == "click", F.concat(F.lit("test_"), _input_topic()))
        .otherwise(F.concat(_input_topic(), F.lit("_old")))
    )
    return kafka_records(events).unionAll(_kafka_row(events, decoy))


def flat_texts(events: DataFrame) -> DataFrame:
    """Flat JSON documents with their folder names; every kind of issue occurs."""
    value, negative = F.col("value").cast("string"), (-F.abs("value")).cast("string")

    def member(name: str, token: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), token)

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    bank, channel = F.concat(F.lit("bank_"), F.lower(_bank_letter())), F.lower(_channel())
    week = F.format_string(
        "%04d-W%02d-%d", F.extract(F.lit("YEAROFWEEK"), "ts"), F.extract(F.lit("WEEK"), "ts"),
        F.extract(F.lit("DAYOFWEEK_ISO"), "ts"),
    )
    identity = F.when(_mod(20) == 15, "null").when(_mod(20) != 5, quoted(_text("E", F.col("event_id"))))
    amount = (
        F.when(_mod(10) == 3, F.lit(None)).when(_mod(10) == 7, '"N/A"').when(_mod(10) == 9, negative)
        .when(_mod(10) == 5, "null").when(_mod(10) == 8, "true").when(_mod(10) == 6, quoted(value)).otherwise(value)
    )
    time = (
        F.when(_mod(12) == 4, F.lit(None)).when(_mod(12) == 8, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .when(_mod(12) == 10, quoted(F.date_format("ts", "dd/MM/yy HH:mm")))
        .when(_mod(12) == 6, quoted(F.date_format("ts", "yyyyMMdd'T'HHmmss")))
        .when(_mod(12) == 2, quoted(week)).when(_mod(12) == 1, '"2024-02-30T10:00:00"').when(_mod(12) == 3, "null")
        .otherwise(quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    )
    members = [
        member("transaction_id", identity),
        member("amount", amount),
        member("timestamp", time),
        member("bank_id", F.when(_mod(33) != 11, quoted(F.upper(bank)))),
        member("channel", F.when(_mod(35) == 12, "null").otherwise(quoted(F.upper(channel)))),
        member("note", quoted(F.col("event_type"))),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    return events.select(
        bank.alias("bank_dir"), channel.alias("channel_dir"),
        F.concat(_text("e", F.col("event_id")), F.lit(".json")).alias("file_name"), text.alias("event_text"),
    )
