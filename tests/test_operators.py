"""Metrics, feeds, topics, windows and the plans behind them."""

import json
import random
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import AS_OF, kafka_records, read_events
from sluicebox.catalog.stored import stored_layers
from sluicebox.constants import CLEAN_FEED_TOPIC, TRANSACTION_TIME_PATTERNS
from sluicebox.functions.values import event_time_of, utc_iso_text
from sluicebox.operators import metrics
from sluicebox.operators.bronze import matching_topics, to_bronze
from sluicebox.operators.feed import clean_feed, publish_frame
from sluicebox.operators.gold import garbage_alert, kpi_window, velocity
from sluicebox.operators.routing import clean_rows, rejected_rows
from sluicebox.operators.silver import flatten, parse_events, to_silver
from sluicebox.schemas import BRONZE_SCHEMA, KAFKA_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from sluicebox.sinks.kafka import write_by_topic, write_feed
from sluicebox.sources.kafka import kafka_options, stream_topics
from sluicebox.sources.layers import read_bronze, read_silver


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return read_silver(spark, stored_layers(spark, "/root/testdata/sf0.001").silver)


# Topics and feeds


def test_topic_pattern_has_to_match_the_whole_name(spark):
    names = [
        "bank_a_atm_transactions", "bank__transactions", "bank_transactions", "xbank_a_transactions",
        "bank_a_transactions_old", "bank_a_transactions\n", CLEAN_FEED_TOPIC,
    ]
    frame = spark.createDataFrame([(n,) for n in names], "topic string")
    assert [r.topic for r in matching_topics(frame).collect()] == names[:2]


def test_fixture_has_the_broker_and_bronze_shape(spark, sf_small):
    records = kafka_records(read_events(spark, sf_small))
    assert records.schema.simpleString() == KAFKA_SCHEMA.simpleString()
    assert to_bronze(records).schema.simpleString() == BRONZE_SCHEMA.simpleString()


def test_feed_leaves_out_nulls_and_rejects(spark, silver):
    row = silver.limit(1).withColumn("masked_card", F.lit(None).cast("string"))
    reject = silver.limit(1).withColumn("quality_score", F.lit("HARD_REJECT"))
    (record,) = clean_feed(row.unionAll(reject)).collect()
    value = json.loads(record.value)
    assert record.key == value["transaction_id"]
    assert list(value) == [c for c in SILVER_COLUMNS if c != "masked_card"]


def test_publishing_stamps_utc_time_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session_zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            texts = spark.sql(
                "SELECT timestamp_micros(1767225600000000) AS t UNION ALL SELECT timestamp_micros(1767225600000120)"
            ).select(utc_iso_text(F.col("t"))).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        assert [t[0] for t in texts] == ["2026-01-01T00:00:00", "2026-01-01T00:00:00.000120"]


def test_published_event_names_its_topic(spark):
    events = spark.createDataFrame([("BANK_B", "POS", "x")], "bank_id string, channel string, source_event_id string")
    (record,) = publish_frame(events, "2026-01-01 00:00:00").collect()
    assert record.topic == "bank_b_pos_transactions"
    assert json.loads(record.value) == {
        "bank_id": "BANK_B", "channel": "POS", "source_event_id": "x", "event_timestamp": "2026-01-01T00:00:00"
    }


def test_kafka_options():
    options = kafka_options("host:9092", max_offsets_per_trigger=1000, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribePattern": "bank_.*_transactions",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
    }


def test_kafka_adapters_reach_the_connector(spark):
    """The connector is not installed here, so the furthest a call can get is its look-up."""
    records = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    for call in (
        lambda: stream_topics(spark, "host:9092"),
        lambda: write_feed(records.drop("topic"), "host:9092"),
        lambda: write_by_topic(records, "host:9092"),
    ):
        with pytest.raises(Exception, match="(?i)kafka"):
            call()


# Metrics


def test_percent_text():
    assert (metrics.percent_text(12.25), metrics.percent_text(100.0)) == ("12.2%", "100.0%")


def test_no_bank_chosen_gives_no_rows(silver):
    assert metrics.of_banks(silver, []).count() == 0


def test_rates_and_freshness_of_empty_layers(spark, silver):
    none = spark.createDataFrame([], SILVER_SCHEMA)
    assert metrics.health_rate(none, none).first().health_rate == 100.0
    assert metrics.freshness(none).first().asDict() == {"last_processed": None, "last_pulse": "N/A"}
    assert metrics.bank_share(none).count() == 0
    assert metrics.health_rate(silver, silver.unionAll(silver)).first().health_rate == 200.0


def test_shares_add_up(silver):
    assert sum(r.share for r in metrics.bank_share(silver).collect()) == pytest.approx(1.0, abs=1e-12)


def test_first_rows_without_order(silver):
    assert metrics.first_rows(silver, 7).count() == 7


# Time patterns


def test_telling_patterns_apart_changes_no_time(spark):
    rng = random.Random(3)
    bases = ["01/03/26 10:00", "2026-03-01 10:20:30", "31/12/69 23:59", "garbage", "2026/03/01 10:20:30", "12/3/2026"]
    texts = [None, ""] + bases
    for _ in range(5000):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(1, 2)):
            text[rng.randrange(len(text))] = rng.choice("0123456789/-: T+")
        texts.append("".join(text))
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    now = F.lit(AS_OF).cast("timestamp")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(p)) for p in TRANSACTION_TIME_PATTERNS], now)
    got = frame.select("t", event_time_of(F.col("t"), now).alias("a"), plain.alias("b"))
    assert got.filter("a IS DISTINCT FROM b").collect() == []
    assert got.filter(f"a <> timestamp '{AS_OF}'").count() > 500


# Aggregates over silver


def random_silver(spark, n, cards, seconds):
    rng = random.Random(11)
    start = datetime(2026, 1, 1)
    data = [
        (rng.choice(cards), start + timedelta(seconds=rng.randrange(seconds)), float(rng.randrange(-500, 5000)) / 100)
        for _ in range(n)
    ]
    frame = spark.createDataFrame(data, "masked_card string, event_timestamp timestamp, amount double")
    return data, frame.withColumns({"bank_id": F.lit("B"), "channel": F.lit("ATM")})


def test_velocity_against_brute_force(spark):
    data, frame = random_silver(spark, 600, ["a", "a", "a", "b", None], 4000)
    span = timedelta(seconds=300)
    got = {(r.masked_card, r.event_timestamp): r for r in velocity(frame, 300).collect()}
    wanted = {(card, at) for card, at, _ in data if card}
    assert set(got) == wanted
    for card, at in wanted:
        amounts = [a for c, t, a in data if c == card and at - span <= t <= at]
        row = got[card, at]
        assert row.txn_count == sum(c == card and t == at for c, t, _ in data)
        assert row.txn_count_span == len(amounts)
        assert row.avg_amount_span == pytest.approx(sum(amounts) / len(amounts), abs=1e-9)


def test_velocity_of_amounts_that_are_no_numbers(spark):
    rows = [("a", datetime(2026, 1, 1), float("nan")), ("a", datetime(2026, 1, 1, 0, 1), 2.0)]
    frame = spark.createDataFrame(rows, "masked_card string, event_timestamp timestamp, amount double")
    first, second = velocity(frame, 300).orderBy("event_timestamp").collect()
    assert first.txn_count_span == 1 and math.isnan(first.avg_amount_span)
    assert second.txn_count_span == 2 and math.isnan(second.avg_amount_span)


def test_no_amount_falls_out_of_a_sum(spark):
    day = datetime(2026, 1, 1)
    rows = [("a", day, "B", "C", x) for x in (1e22, 2.0, 4e-7)] + [("b", day, "B", "D", float("inf")), ("b", day, "B", "D", 1.0)]
    frame = spark.createDataFrame(rows, "masked_card string, event_timestamp timestamp, bank_id string, channel string, amount double")
    totals = {r.channel: r.total_amount for r in kpi_window(frame).collect()}
    assert totals == {"C": 1e22 + 2.0000004, "D": math.inf}
    averages = {r.masked_card: r.avg_amount_span for r in velocity(frame, 300).collect()}
    assert averages == {"a": (1e22 + 2.0000004) / 3, "b": math.inf}


def test_large_amounts_leave_the_span_again(spark):
    rows = [("a", datetime(2026, 1, 1, 0, 0, s), x) for s, x in ((0, 1e22), (4, 3.0), (9, 5.0))]
    frame = spark.createDataFrame(rows, "masked_card string, event_timestamp timestamp, amount double")
    spans = [r.avg_amount_span for r in velocity(frame, 5).orderBy("event_timestamp").collect()]
    assert spans == [1e22, 5e21, 4.0]


def test_hot_card_is_spread_over_buckets(spark):
    """One card holds every row; no window group may hold them all."""
    _, frame = random_silver(spark, 5000, ["a"], 20000)
    plan = physical(velocity(frame, 300))
    assert "hashpartitioning(masked_card" in plan and "bucket" in plan
    assert velocity(frame, 300).agg(F.sum("txn_count")).first()[0] == 5000


def test_sliding_kpi(spark):
    data, frame = random_silver(spark, 300, ["a"], 7200)
    tumbling = kpi_window(frame, "1 hour").agg(F.sum("txn_count")).first()[0]
    sliding = kpi_window(frame, "1 hour", "30 minutes").agg(F.sum("txn_count")).first()[0]
    assert (tumbling, sliding) == (300, 600)


def test_alert_only_above_the_threshold(spark, sf_small):
    scored = to_silver(to_bronze(kafka_records(read_events(spark, sf_small))), AS_OF)
    some, none, every = (garbage_alert(scored, t, "1 day").count() for t in (0.4, 1.0, -1.0))
    assert 0 < some < every and none == 0


# Plans


def test_refinement_is_narrow_and_reads_one_column(spark):
    plan = physical(to_silver(read_bronze(spark, stored_layers(spark, "/root/testdata/sf0.001").bronze), AS_OF))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<raw_payload:string>" in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_filters_do_not_repeat_the_parse(spark):
    bronze = read_bronze(spark, stored_layers(spark, "/root/testdata/sf0.001").bronze)
    for side in (clean_rows, rejected_rows):
        assert physical(side(to_silver(bronze, AS_OF))).count("from_json") == 1
    plain = flatten(parse_events(bronze)).filter("amount IS NOT NULL AND bank_id IS NOT NULL")
    assert physical(plain).count("from_json") > 1  # what the generator avoids


def test_bank_filter_prunes_partitions(silver):
    plan = physical(metrics.of_banks(silver, ["BANK_A", "BANK_B"]).select("amount"))
    assert "PartitionFilters: [bank_id" in plan.replace("cast(", "") and "ReadSchema: struct<amount:double>" in plan


def test_bank_counts_read_no_data_column_and_shares_reuse_them(silver):
    assert "ReadSchema: struct<>" in physical(metrics.bank_distribution(silver))
    shares = metrics.bank_share(silver)
    shares.collect()
    assert "ReusedExchange" in physical(shares) and "CartesianProduct" not in physical(shares)
    assert "Window" not in physical(shares)
