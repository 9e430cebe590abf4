"""Compaction of batch folders beside readers and over crashes; mergeable hourly states."""

import math

import pytest
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import AS_OF, kafka_records, read_events
from sluicebox.operators.bronze import to_bronze
from sluicebox.operators.sketches import figures, hourly_states, merged_states, per_period
from sluicebox.plans import compact as compaction
from sluicebox.plans.compact import compact, drop_replaced, due, folder_sizes, last_closed_batch
from sluicebox.schemas import SILVER_SCHEMA
from sluicebox.sources import batches
from sluicebox.sources.layers import read_garbage, read_silver
from sluicebox.streaming.refine import start_silver, stream_bronze


@pytest.fixture
def lake(spark, tmp_path, sf_small):
    to_bronze(kafka_records(read_events(spark, sf_small))).repartition(5, "offset").write.parquet(f"{tmp_path}/bronze")
    refine(spark, tmp_path)
    return tmp_path


def refine(spark, base):
    source = stream_bronze(spark, f"{base}/bronze", 1)
    start_silver(source, f"{base}/silver", f"{base}/garbage", f"{base}/checkpoint", as_of=AS_OF).awaitTermination()


def rows(frame):
    return sorted(map(repr, frame.collect()))


def names(spark, path):
    return {r["batch_id"] for r in folder_sizes(spark, path).collect()}


@pytest.mark.parametrize(("layer", "fmt", "read"), [("silver", "parquet", read_silver), ("garbage", "json", read_garbage)])
def test_rows_are_the_same_before_during_and_after(spark, lake, sf_small, monkeypatch, layer, fmt, read):
    path, checkpoint = f"{lake}/{layer}", f"{lake}/checkpoint"
    want = rows(read(spark, path))
    assert last_closed_batch(spark, checkpoint) == 4 and names(spark, path) == {"0", "1", "2", "3", "4"}

    def dies(*args):
        raise RuntimeError("lost")

    for step in ("write_folders", "publish"):  # dies before any folder is there, and before the marker is
        with monkeypatch.context() as patched:
            patched.setattr(compaction, step, dies)
            with pytest.raises(RuntimeError, match="lost"):
                compact(spark, path, checkpoint, fmt, 1 << 30, closed_only=False)
        assert rows(read(spark, path)) == want
    assert len(names(spark, path)) == 6
    added = compact(spark, path, checkpoint, fmt, 1 << 30, closed_only=False)
    assert [(m.first, m.last) for m in added] == [(0, 4)]
    assert rows(read(spark, path)) == want
    assert compact(spark, path, checkpoint, fmt, 1 << 30, closed_only=False) == []
    assert drop_replaced(spark, path) == 6  # five batches and what the compaction that died has left
    assert names(spark, path) == {added[0].folder} and rows(read(spark, path)) == want
    assert drop_replaced(spark, path) == 0
    to_bronze(kafka_records(read_events(spark, sf_small))).coalesce(1).write.mode("append").parquet(f"{lake}/bronze")
    refine(spark, lake)
    assert names(spark, path) == {added[0].folder, "5"} and rows(read(spark, path)) == sorted(want * 2)


def test_a_marker_that_appears_while_files_are_listed(spark, lake, monkeypatch):
    path = f"{lake}/silver"
    want, look, calls = rows(read_silver(spark, path)), batches.compactions, []

    def looked(session, layer):
        found = look(session, layer)
        if not calls:  # after the first look, all of a compaction happens
            calls.append(1)
            monkeypatch.setattr(batches, "compactions", look)
            compact(spark, path, f"{lake}/checkpoint", target_bytes=1 << 30, closed_only=False)
            drop_replaced(spark, path)
        return found

    monkeypatch.setattr(batches, "compactions", looked)
    assert rows(read_silver(spark, path)) == want


def test_ranges_are_consecutive_and_reach_the_target(spark):
    sizes = [("a", str(i), 10) for i in range(10)] + [("b", "3", 500), ("b", "4", 1), ("b", "9", 1)]
    frame = spark.createDataFrame(sizes, "run string, batch_id string, bytes long")
    got = sorted((r["run"], r["first"], r["last"]) for r in due(frame, 30).collect())
    assert got == [("a", 0, 2), ("a", 3, 5), ("a", 6, 8)]
    every = sorted((r["run"], r["first"], r["last"]) for r in due(frame, 30, closed_only=False).collect())
    assert every == [*got, ("b", 4, 9)]


def silver_of(spark, values):
    at = F.lit("2024-01-01 05:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    frame = spark.createDataFrame(values, "hour int, bank_id string, masked_card string, amount double")
    named = frame.withColumn("event_timestamp", at)
    return named.select(*[
        (F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER_SCHEMA
    ])


def test_states_of_nulls_and_of_no_rows(spark):
    hard = [(0, "A", None, None), (0, "A", None, math.nan), (1, "A", "x", 5.0), (1, None, "x", -1.0), (30, "A", "x", math.inf)]
    days = per_period(hourly_states(silver_of(spark, hard)), "day", "bank_id")
    got = {(r.window_start.day, r.bank_id): r for r in figures(days, [0.0, 1.0]).collect()}
    assert got[(1, "A")].txn_count == 3 and math.isnan(got[(1, "A")].total_amount)
    assert got[(1, "A")].distinct_cards == 1 and got[(1, "A")].amount_quantiles == [5.0, 5.0]
    assert got[(1, None)].total_amount == -1.0 and got[(2, "A")].amount_quantiles == [math.inf, math.inf]
    only_null = figures(hourly_states(silver_of(spark, hard[:2]))).first()
    assert only_null.distinct_cards == 0 and only_null.amount_quantiles is None
    assert figures(per_period(hourly_states(silver_of(spark, [])), "month")).count() == 0


def test_merged_states_keep_their_errors(spark):
    count = 200_000
    frame = spark.range(count, numPartitions=16).select(
        (F.col("id") % 700).cast("int").alias("hour"), F.lit("A").alias("bank_id"),
        F.sha2((F.col("id") % 50_000).cast("string"), 256).alias("masked_card"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100).alias("amount"),
    )
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    silver = frame.withColumns({"event_timestamp": at, "channel": F.lit("ATM")})
    months = merged_states(per_period(hourly_states(silver), "day", "bank_id"), ["bank_id"])
    row = figures(months, [0.1, 0.5, 0.9]).first()
    assert row.txn_count == count and abs(row.distinct_cards / 50_000 - 1) < 0.065
    assert all(abs(value / 10_000 - q) < 0.03 for value, q in zip(row.amount_quantiles, [0.1, 0.5, 0.9]))
