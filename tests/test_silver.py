"""Edge cases of the silver transform, one row each."""

import hashlib
import json
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicebox.functions.quality import VALIDITY
from sluicebox.functions.values import instant
from sluicebox.operators.silver import flatten, parse_events, parse_once, refine, to_silver
from sluicebox.schemas import EVENT_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA

AS_OF = "2026-06-01 12:00:00"
FALLBACK = datetime(2026, 6, 1, 12)


def event(**changes):
    """A valid event; dotted keys reach inside, DROP removes."""
    base = {
        "bank_id": "BANK_A",
        "channel": "ATM",
        "raw_payload": {"atmCode": "A1", "trxAmt": "12.5", "trxTime": "01/03/26 10:00", "cardNumber": "****1234"},
        "ingest_time": "2026-03-01T10:00:00",
        "source_event_id": "id-1",
        "extra_metadata": {"branch_id": "B1", "device_status": "OK"},
    }
    for key, value in changes.items():
        *outer, last = key.split("__")
        target = base
        for name in outer:
            target = target[name]
        if value is DROP:
            del target[last]
        else:
            target[last] = value
    return json.dumps(base)


DROP = object()


def bronze(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "raw_payload string")
    return frame.withColumn("ingest_time", F.lit(AS_OF).cast("timestamp"))


def silver(spark, texts, **options):
    scored = to_silver(bronze(spark, texts), AS_OF, **options)
    return scored.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).collect()


CASES = {
    "valid": (event(), {"quality_score": "CLEAN", "amount": 12.5, "event_timestamp": datetime(2026, 3, 1, 10)}),
    "malformed": ("{not json", {"quality_score": "HARD_REJECT", "transaction_id": None, "event_timestamp": FALLBACK}),
    "array": ('[{"bank_id": "X"}]', {"quality_score": "HARD_REJECT"}),
    "empty text": ("", {"quality_score": "HARD_REJECT", "event_timestamp": FALLBACK}),
    "null text": (None, {"quality_score": "HARD_REJECT"}),
    "cut off": (event()[:-1], {"quality_score": "HARD_REJECT"}),
    "duplicate key": (event()[:-1] + ', "bank_id": "BANK_Z"}', {"bank_id": "BANK_Z", "quality_score": "CLEAN"}),
    "unknown field": (event(event_timestamp="2026-01-01T00:00:00"), {"quality_score": "CLEAN"}),
    "extra_field text": (event(raw_payload__extra_field="many"), {"quality_score": "CLEAN", "amount": 12.5}),
    "payload is text": (event(raw_payload="x"), {"quality_score": "HARD_REJECT", "amount": None, "bank_id": "BANK_A"}),
    "amount null": (event(raw_payload__trxAmt=None), {"quality_score": "HARD_REJECT", "amount": None}),
    "amount absent": (event(raw_payload__trxAmt=DROP), {"quality_score": "HARD_REJECT", "amount": None}),
    "amount N/A": (event(raw_payload__trxAmt="N/A"), {"quality_score": "HARD_REJECT", "amount": None}),
    "amount ???": (event(raw_payload__trxAmt="???"), {"quality_score": "HARD_REJECT", "amount": None}),
    "amount number": (event(raw_payload__trxAmt=12.50), {"quality_score": "CLEAN", "amount": 12.5}),
    "amount infinite": (event(raw_payload__trxAmt="Infinity"), {"quality_score": "CLEAN", "amount": math.inf}),
    "amount 12d": (event(raw_payload__trxAmt="12d"), {"quality_score": "CLEAN", "amount": 12.0}),
    "amount padded": (event(raw_payload__trxAmt=" 12 "), {"quality_score": "CLEAN", "amount": 12.0}),
    "amount negative": (event(raw_payload__trxAmt="-5"), {"quality_score": "CLEAN", "amount": -5.0}),
    "device WARN": (event(extra_metadata__device_status="WARN"), {"quality_score": "CLEAN", "status": "WARN"}),
    "no card": (event(raw_payload__cardNumber=DROP), {"quality_score": "CLEAN", "masked_card": None}),
    "empty bank": (event(bank_id=""), {"quality_score": "CLEAN", "bank_id": ""}),
    "empty id": (event(source_event_id=""), {"quality_score": "CLEAN", "transaction_id": ""}),
    "empty branch": (event(extra_metadata__branch_id=""), {"quality_score": "CLEAN"}),
    "empty status": (event(extra_metadata__device_status=""), {"quality_score": "CLEAN", "status": ""}),
    "no bank": (event(bank_id=DROP), {"quality_score": "HARD_REJECT"}),
    "no id": (event(source_event_id=None), {"quality_score": "HARD_REJECT"}),
    "no metadata": (event(extra_metadata=DROP), {"quality_score": "WARNING_MISSING_CONTEXT", "status": None}),
    "no branch": (event(extra_metadata__branch_id=DROP), {"quality_score": "WARNING_MISSING_CONTEXT"}),
    "no status": (event(extra_metadata__device_status=None), {"quality_score": "WARNING_MISSING_CONTEXT"}),
    "no bank and no metadata": (event(bank_id=None, extra_metadata=None), {"quality_score": "HARD_REJECT"}),
    "no channel": (event(channel=None), {"quality_score": "CLEAN", "channel": None}),
    "year 70": (event(raw_payload__trxTime="01/03/70 10:00"), {"event_timestamp": datetime(2070, 3, 1, 10)}),
    "second pattern": (
        event(raw_payload__trxTime="2026-03-01 10:20:30"), {"event_timestamp": datetime(2026, 3, 1, 10, 20, 30)}
    ),
}


@pytest.fixture(scope="module")
def outcomes(spark):
    return dict(zip(CASES, silver(spark, [text for text, _ in CASES.values()])))


@pytest.mark.parametrize("name", CASES)
def test_edge_case(outcomes, name):
    row = outcomes[name].asDict()
    expected = CASES[name][1]
    assert {key: row[key] for key in expected} == expected


def test_nan_amount_is_clean(spark):
    (row,) = silver(spark, [event(raw_payload__trxAmt="NaN")])
    assert math.isnan(row.amount) and row.quality_score == "CLEAN"


def test_times_that_match_no_pattern_fall_back(spark):
    texts = [
        "1/3/26 10:00", "01/03/26 1:00", "31/02/26 10:00", "01/03/26 24:00", "01/03/26 10:00:00", " 01/03/26 10:00",
        "2026-03-01T10:00:00", "2026-03-01 10:00:00.5", "2026-03-01 10:00", "01/03/2026 10:00", "", "garbage",
    ]
    rows = silver(spark, [event(raw_payload__trxTime=t) for t in texts])
    assert [(t, r.event_timestamp) for t, r in zip(texts, rows) if r.event_timestamp != FALLBACK] == []


def test_card_is_hashed_and_gone(spark):
    frame = to_silver(bronze(spark, [event()]), AS_OF)
    assert frame.columns == SILVER_COLUMNS and frame.schema.simpleString() == SILVER_SCHEMA.simpleString()
    (row,) = frame.collect()
    assert row.masked_card == hashlib.sha256(b"****1234").hexdigest()
    assert "1234" not in json.dumps(row.asDict() | {"masked_card": None}, default=str)


def test_fallback_rows_carry_the_processing_time(spark):
    frame = to_silver(bronze(spark, [event(raw_payload__trxTime="x"), event()]))
    same = frame.select((F.col("event_timestamp") == F.col("processed_at")).alias("same")).collect()
    assert [r.same for r in same] == [True, False]


def test_naive_processing_time_is_refused():
    with pytest.raises(ValueError):
        instant(datetime(2026, 1, 1))


def test_parsing_through_a_generator_changes_nothing(spark):
    texts = [text for text, _ in CASES.values()]
    raw = bronze(spark, texts)
    whole = refine(flatten(parse_events(raw, EVENT_SCHEMA)), AS_OF).collect()
    once = refine(parse_once(raw), AS_OF).collect()
    assert whole == once


def test_damaged_texts_give_the_same_rows_either_way(spark):
    rng = random.Random(5)
    extras = [1, "many", 1.5, 10**30, None, [1], {"a": 1}, True, -(2**31) - 1]
    texts = []
    for i in range(6000):
        text = list(event(raw_payload__extra_field=rng.choice(extras), raw_payload__atmCode=rng.choice(["A", 1, None, {}])))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 2)] = rng.choice(['"', "{", "}", "[", ",", ":", "0", "x", "\\", " ", "é", "null", ""])
        texts.append("".join(text))
    raw = bronze(spark, texts)
    whole = refine(flatten(parse_events(raw, EVENT_SCHEMA)), AS_OF).collect()
    once = refine(parse_once(raw), AS_OF).collect()
    assert [(t, a, b) for t, a, b in zip(texts, whole, once) if a != b][:3] == []
    partly = event(raw_payload__atmCode={}).replace("{}", "{[}")  # breaks inside a field that silver drops
    (kept,) = silver(spark, [partly])
    assert kept.quality_score == "CLEAN" and kept.amount == 12.5
    labels = {r.quality_score for r in once}
    assert labels == {"CLEAN", "HARD_REJECT", "WARNING_MISSING_CONTEXT"}


def test_documented_rules(spark):
    texts = [
        event(), event(raw_payload__trxAmt="N/A"), event(raw_payload__trxAmt="-1"),
        event(extra_metadata__device_status="WARN"), event(extra_metadata=None), event(bank_id=None),
        event(raw_payload__trxAmt="-1", extra_metadata__device_status="WARN"), event(raw_payload__trxAmt="NaN"),
    ]
    labels = [r.quality_score for r in silver(spark, texts, rules=VALIDITY)]
    assert labels == [
        "CLEAN", "MISSING_AMOUNT", "INVALID_VALUE", "DEVICE_WARNING", "CLEAN", "CLEAN", "INVALID_VALUE", "CLEAN"
    ]
