"""Runs, decayed averages, offset audit, and the streams beside them, on hand-made and random rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from sluicebox.operators.decay import decayed_averages
from sluicebox.operators.gold import velocity
from sluicebox.operators.runs import card_sessions, garbage_incidents, join_runs, offset_audit
from sluicebox.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from sluicebox.streaming.repeats import start_without_repeats
from sluicebox.streaming.velocity import start_velocity

START = datetime(2024, 1, 1)
FALLBACK = datetime(2024, 3, 1)


def silver(spark, rows):
    """Rows (seconds after the start, card, amount)."""
    full = [
        (f"T{n}", START + timedelta(seconds=s) if s is not None else FALLBACK, "BANK_A", "ATM", amount, card, "OK", "CLEAN", FALLBACK)
        for n, (s, card, amount) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SILVER_SCHEMA)


def random_rows(seed, n=600, cards=4, seconds=40_000):
    rng = random.Random(seed)
    return [(int(rng.random() ** 2 * seconds), f"c{int(rng.random() ** 3 * cards)}", round(rng.uniform(-5, 500), 2)) for _ in range(n)]


def plain_runs(places, gap):
    runs = []
    for p in sorted(set(places)):
        if runs and p - runs[-1][1] <= gap:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return [tuple(r) for r in runs]


@pytest.mark.parametrize("gap,widths", [(3, [5]), (3, [4, 16]), (1, [7, 70, 700]), (50, [10]), (0, [10])])
def test_runs_over_bucket_edges(spark, gap, widths):
    rng = random.Random(gap)
    points = sorted({(k, rng.randrange(-400, 400)) for k in ("a", "b", None) for _ in range(150)}, key=repr)
    frame = spark.createDataFrame([(k, p, p) for k, p in points], "k string, first long, last long")
    got = {(r.k, r.first, r.last) for r in join_runs(frame, ["k"], gap, widths, {}).collect()}
    want = {(k, *run) for k in ("a", "b", None) for run in plain_runs([p for x, p in points if x == k], gap)}
    assert got == want


def test_runs_of_nothing(spark):
    frame = spark.createDataFrame([], "k string, first long, last long")
    assert join_runs(frame, ["k"], 1, [5], {}).count() == 0


def test_sessions_of_odd_rows(spark):
    rows = silver(spark, [(0, "c", 1.0), (0, "c", float("nan")), (5, "c", 2.0), (20, "c", 1e30), (0, None, 1.0), (15, "d", None)])
    got = Counter((r.masked_card, (r.session_end - r.session_start).seconds, r.txn_count, repr(r.total_amount)) for r in card_sessions(rows, 10, 7).collect())
    assert got == Counter({("c", 5, 3, "nan"): 1, ("c", 0, 1, "1e+30"): 1, ("d", 0, 1, "None"): 1})
    assert card_sessions(rows.limit(0)).count() == 0


def test_a_hot_card_is_spread(spark):
    rows = silver(spark, [(s, "hot", 1.0) for s in range(0, 5000, 2)])
    assert [(r.txn_count, r.total_amount) for r in card_sessions(rows, 2, 60).collect()] == [(2500, 2500.0)]
    assert card_sessions(rows, 1, 60).count() == 2500


def test_incidents(spark):
    rejected = {0, 1, 2, 5, 6, 9, 30}
    rows = [(m * 60 + s, s < 3 if m in rejected else False) for m in range(40) for s in range(4)]
    scored = silver(spark, [(s, "c", 1.0) for s, _ in rows]).toPandas()
    scored["quality_score"] = ["HARD_REJECT" if bad else "CLEAN" for _, bad in rows]
    frame = spark.createDataFrame(scored, SILVER_SCHEMA)
    minute = timedelta(minutes=1)

    def shown(quiet):
        found = garbage_incidents(frame, 0.5, 60, quiet, bucket_windows=2).orderBy("incident_start").collect()
        return [((r.incident_start - START) // minute, (r.incident_end - START) // minute, r.windows, r.total, r.rejected, r.peak_rate) for r in found]

    assert shown(0) == [(0, 3, 3, 12, 9, 0.75), (5, 7, 2, 8, 6, 0.75), (9, 10, 1, 4, 3, 0.75), (30, 31, 1, 4, 3, 0.75)]
    assert shown(2) == [(0, 10, 6, 24, 18, 0.75), (30, 31, 1, 4, 3, 0.75)]
    assert garbage_incidents(frame.limit(0), 0.5).count() == 0


def plain_decay(rows, life):
    """The recursion: both sums shrink by the time between, then take what is new."""
    found = {}
    for card in {c for _, c, _ in rows if c is not None}:
        known = Counter()
        for s, c, a in rows:
            if c == card and a is not None and abs(a) <= 1e100:
                known[s] += 1
        n = total = 0.0
        before = None
        for s in sorted(known):
            shrink = 2.0 ** (-(s - before) / life) if before is not None else 0.0
            n = n * shrink + known[s]
            total = total * shrink + sum(a for t, c, a in rows if c == card and t == s and a is not None and abs(a) <= 1e100)
            before = s
            found[card, s] = (known[s], n, total / n)
    return found


@pytest.mark.parametrize("life", [20, 600, 100_000])
def test_decayed_averages_equal_the_recursion(spark, life):
    rows = random_rows(life) + [(50, None, 1.0), (60, "c0", None), (70, "c1", float("nan")), (80, "c1", float("inf")), (90, "x", None)]
    got = {
        (r.masked_card, int((r.event_timestamp - START).total_seconds())): (r.txn_count, r.decayed_count, r.decayed_average)
        for r in decayed_averages(silver(spark, rows), life).collect()
    }
    want = plain_decay(rows, life)
    assert set(got) == set(want)
    for key, (n, count, average) in want.items():
        assert got[key][0] == n
        assert got[key][1:] == (pytest.approx(count, rel=1e-9), pytest.approx(average, rel=1e-9, abs=1e-9))


def bronze(spark, rows):
    full = [(None, "{}", topic, part, offset, START + timedelta(seconds=min(offset or 0, 10**6))) for topic, part, offset in rows]
    return spark.createDataFrame(full, BRONZE_SCHEMA)


@pytest.mark.parametrize("width", [3, 10, 1_000_000])
def test_offsets(spark, width):
    rows = [("a", 0, o) for o in (5, 6, 9, 10, 11, 30, 30, 30)] + [("a", 1, 7), ("b", 0, 2**62), ("b", 0, 2**62 + 4), ("a", None, 1), ("a", 0, None)]
    got = {tuple(r) for r in offset_audit(bronze(spark, rows), width).collect()}
    assert got == {
        ("a", 0, "missing", 7, 8, 2), ("a", 0, "missing", 12, 29, 18), ("a", 0, "repeated", 30, 30, 2), ("b", 0, "missing", 2**62 + 1, 2**62 + 3, 3),
    }
    assert offset_audit(bronze(spark, rows).limit(0)).count() == 0


def in_files(frame, path, parts):
    for part in parts:
        frame.filter(part).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def as_rows(frame):
    return Counter(tuple(r) for r in frame.select("masked_card", "event_timestamp", "txn_count", "txn_count_span", "avg_amount_span").collect())


@pytest.mark.parametrize("order,tick", [("in order", 600), ("out of order", None)])
def test_velocity_of_a_stream_equals_the_batch(spark, tmp_path, order, tick):
    rows = random_rows(5, 200, 3, 9_000) + [(100, "c0", None), (101, "c0", 1e30), (None, "c0", 7.0), (102, None, 1.0)]
    frame = silver(spark, rows)
    frame.write.parquet(f"{tmp_path}/all")
    kept = spark.read.schema(SILVER_SCHEMA).parquet(f"{tmp_path}/all")
    number = "cast(substr(transaction_id, 2) as int)"
    parts = [f"{number} % 3 = {n}" for n in range(3)]
    if order == "in order":
        parts = [f"unix_seconds(event_timestamp) - unix_seconds(timestamp'2024-01-01') between {a} and {b}" for a, b in ((0, 2999), (3000, 5999), (6000, 10**9))]
    late = "10 seconds" if order == "in order" else "1 day"

    def run():
        start_velocity(stream(spark, f"{tmp_path}/in", SILVER_SCHEMA), f"{tmp_path}/out", f"{tmp_path}/c", 1800, late, tick).awaitTermination()

    in_files(kept, f"{tmp_path}/in", parts[:1])
    run()
    in_files(kept, f"{tmp_path}/in", parts[1:])
    run()
    closing = silver(spark, [(10**6, "closing", 1.0), (2 * 10**6, "closing", 1.0)])
    in_files(closing, f"{tmp_path}/in", ["true"])
    run()
    run()  # nothing new
    got = as_rows(spark.read.parquet(f"{tmp_path}/out").filter("masked_card <> 'closing'"))
    assert got == as_rows(velocity(kept.filter("event_timestamp <> processed_at"), 1800))


def test_velocity_of_many_cards_takes_few_state_keys(spark, tmp_path):
    """Thousands of cards in one bucket share keys of the state, whose calls cost far more than rows; their sums stay apart."""
    rows = [(n % 50, f"c{n}", float(n)) for n in range(3_000)] + [(60, f"c{n}", None) for n in range(0, 3_000, 7)]
    in_files(silver(spark, rows), f"{tmp_path}/in", ["true"])
    in_files(silver(spark, [(10**6, "closing", 1.0)]), f"{tmp_path}/in", ["true"])
    query = start_velocity(stream(spark, f"{tmp_path}/in", SILVER_SCHEMA), f"{tmp_path}/out", f"{tmp_path}/c", 600, "10 seconds")
    query.awaitTermination()
    got = as_rows(spark.read.parquet(f"{tmp_path}/out").filter("masked_card <> 'closing'"))
    assert got == as_rows(velocity(silver(spark, rows), 600))
    assert max(p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators) < 1_000


def test_ticks_have_to_divide_the_span(spark, tmp_path):
    with pytest.raises(ValueError):
        start_velocity(silver(spark, []), "x", "y", 1800, tick_seconds=7)


def test_repeats_within_and_beyond_the_span(spark, tmp_path):
    def run(rows):
        bronze(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = stream(spark, f"{tmp_path}/in", BRONZE_SCHEMA)
        start_without_repeats(source, f"{tmp_path}/out", f"{tmp_path}/c", within="100 seconds").awaitTermination()
        return Counter((r.topic, r.partition, r.offset) for r in spark.read.schema(BRONZE_SCHEMA).parquet(f"{tmp_path}/out").collect())

    first = [("a", 0, 1), ("a", 0, 2), ("a", 0, 2), ("a", 1, 1), (None, 0, 3), (None, 0, 3)]
    once = Counter({("a", 0, 1): 1, ("a", 0, 2): 1, ("a", 1, 1): 1, (None, 0, 3): 2})
    assert run(first) == once
    assert run(first[:4]) == once  # a replay after a restart adds nothing
    assert run([("a", 0, 500)]) == once + Counter([("a", 0, 500)])
    late = run([("a", 0, 1), ("a", 0, 3), ("a", 0, 450)])  # older than the watermark of 400: dropped, new or not
    assert late == once + Counter([("a", 0, 500), ("a", 0, 450)])
