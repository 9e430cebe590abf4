"""Streams give what the batch gives, and a rerun adds nothing."""

import inspect
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import AS_OF, EVENTS_SCHEMA, kafka_records, read_events
from sluicebox.catalog.stored import stored_layers
from sluicebox.operators.bronze import to_bronze
from sluicebox.operators.gold import kpi_window
from sluicebox.operators.routing import clean_rows, rejected_rows
from sluicebox.operators.silver import to_silver
from sluicebox.schemas import SILVER_COLUMNS, SILVER_SCHEMA
from sluicebox.sinks.files import write_silver
from sluicebox.sources.layers import read_bronze, read_garbage, read_silver
from sluicebox.streaming.ingest import ALL_AVAILABLE, run_ingest, start_bronze, start_console
from sluicebox.streaming.kpi import start_kpi, start_undated
from sluicebox.streaming.refine import batch_folder, start_silver, stream_bronze


def source(spark, sf_dir):
    events = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return kafka_records(events)


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_bronze_stream_equals_batch_and_stray_files_do_not_count(spark, sf_small, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    expected = to_bronze(kafka_records(read_events(spark, sf_small)))
    for _ in range(2):
        start_bronze(source(spark, sf_small), path, checkpoint, ALL_AVAILABLE).awaitTermination()
        assert rows(read_bronze(spark, path)) == rows(expected)
    expected.limit(5).write.parquet(str(tmp_path / "other"))
    stray = next((tmp_path / "other").glob("*.parquet"))
    (tmp_path / "bronze" / "stray.parquet").write_bytes(stray.read_bytes())
    assert read_bronze(spark, path).count() == expected.count()


def test_two_queries_from_one_source(spark, sf_small, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    run_ingest(spark, source(spark, sf_small), path, checkpoint, ALL_AVAILABLE, echo=True)
    assert not spark.streams.active
    assert read_bronze(spark, path).count() == read_events(spark, sf_small).count()


def test_an_error_of_one_query_stops_the_other_and_is_raised(spark, sf_small, tmp_path):
    path, checkpoint = tmp_path / "bronze", str(tmp_path / "checkpoint")
    path.write_text("a file where the folder should be")
    with pytest.raises(Exception):  # noqa: B017  Spark's own stream error
        run_ingest(spark, source(spark, sf_small), str(path), checkpoint, echo=True)
    assert not spark.streams.active


def test_console_echo_reads_the_source_by_itself(spark, sf_small):
    echo = start_console(source(spark, sf_small), ALL_AVAILABLE)
    echo.awaitTermination()
    progress = echo.recentProgress
    assert sum(p.numInputRows for p in progress) == read_events(spark, sf_small).count()
    assert "Console" in progress[0].sink.description


@pytest.mark.parametrize("hold", ["persist", "table"])
def test_silver_stream_equals_batch(spark, sf_small, tmp_path, hold):
    bronze = stored_layers(spark, sf_small).bronze
    silver, garbage, checkpoint = (str(tmp_path / n) for n in ("silver", "garbage", "checkpoint"))
    scored = to_silver(read_bronze(spark, bronze), AS_OF)
    for _ in range(2):
        stream = stream_bronze(spark, bronze)
        start_silver(stream, silver, garbage, checkpoint, as_of=AS_OF, hold=hold).awaitTermination()
        assert rows(read_silver(spark, silver)) == rows(clean_rows(scored))
        assert rows(read_garbage(spark, garbage)) == rows(rejected_rows(scored))


def test_new_files_are_added_in_batches(spark, sf_small, tmp_path):
    records = to_bronze(kafka_records(read_events(spark, sf_small)))
    bronze, silver, garbage, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "garbage", "checkpoint"))

    def run():
        stream = stream_bronze(spark, bronze, max_files_per_trigger=1)
        start_silver(stream, silver, garbage, checkpoint, as_of=AS_OF).awaitTermination()

    records.filter("offset < 500").repartition(2).write.parquet(bronze)
    run()
    first = read_silver(spark, silver).count()
    records.filter("offset >= 500").coalesce(1).write.mode("append").parquet(bronze)
    run()
    scored = to_silver(records, AS_OF)
    assert 0 < first < read_silver(spark, silver).count() == clean_rows(scored).count()
    assert len(list((tmp_path / "silver").glob("run=*/batch_id=*"))) == 3


def test_a_batch_that_was_half_written_is_replaced(spark, sf_small, tmp_path):
    bronze = stored_layers(spark, sf_small).bronze
    silver, garbage, checkpoint = (str(tmp_path / n) for n in ("silver", "garbage", "checkpoint"))
    scored = to_silver(read_bronze(spark, bronze), AS_OF)
    query = start_silver(stream_bronze(spark, bronze), silver, garbage, checkpoint, as_of=AS_OF)
    query.awaitTermination()
    write_silver(clean_rows(scored).limit(100), batch_folder(silver, query.id, 0))  # what a died run left behind
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        commit.unlink()
    start_silver(stream_bronze(spark, bronze), silver, garbage, checkpoint, as_of=AS_OF).awaitTermination()
    assert rows(read_silver(spark, silver)) == rows(clean_rows(scored))


def test_a_new_checkpoint_keeps_what_earlier_ones_wrote(spark, sf_small, tmp_path):
    bronze, few = stored_layers(spark, sf_small).bronze, str(tmp_path / "few")
    read_bronze(spark, bronze).limit(50).write.parquet(few)
    silver, garbage = str(tmp_path / "silver"), str(tmp_path / "garbage")
    for i, path in enumerate((bronze, few)):
        start_silver(stream_bronze(spark, path), silver, garbage, str(tmp_path / f"c{i}"), as_of=AS_OF).awaitTermination()
    count = read_silver(spark, silver).count() + read_garbage(spark, garbage).count()
    assert count == read_bronze(spark, bronze).count() + 50


def test_nothing_is_persisted_by_default(spark, sf_small, tmp_path):
    bronze = stored_layers(spark, sf_small).bronze
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    start_silver(stream_bronze(spark, bronze), *(str(tmp_path / n) for n in "sgc"), as_of=AS_OF).awaitTermination()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert inspect.signature(start_silver).parameters["hold"].default == "table"


def test_rows_without_a_time_do_not_move_the_watermark(spark, tmp_path):
    """Two batches; the first holds a row whose time is the current one. Older rows of the second still count."""
    now = datetime(2030, 1, 1)
    times = [[datetime(2026, 1, 1, 10), now], [datetime(2026, 1, 1, 11), datetime(2026, 1, 9)]]
    folder = str(tmp_path / "silver")
    for batch in times:
        values = [("t", at, "B", "C", 1.0, None, None, "CLEAN", now) for at in batch]
        spark.createDataFrame(values, SILVER_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SILVER_SCHEMA).parquet(folder)
        start_kpi(stream, str(tmp_path / "kpi"), str(tmp_path / "c1"), "1 hour", "2 days").awaitTermination()
        start_undated(stream, str(tmp_path / "undated"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "kpi")).agg(F.sum("txn_count")).first()[0] == 2
    assert spark.read.parquet(str(tmp_path / "undated")).count() == 1


def test_each_batch_has_one_processing_time(spark, sf_small, tmp_path):
    bronze = stored_layers(spark, sf_small).bronze
    silver, garbage, checkpoint = (str(tmp_path / n) for n in ("silver", "garbage", "checkpoint"))
    start_silver(stream_bronze(spark, bronze), silver, garbage, checkpoint).awaitTermination()
    both = read_silver(spark, silver).unionAll(read_garbage(spark, garbage))
    assert both.select(F.date_trunc("second", "processed_at")).distinct().count() == 1
    assert both.select(*SILVER_COLUMNS).count() == read_bronze(spark, bronze).count()


def test_kpi_stream_gives_the_closed_windows_of_the_batch(spark, sf_small, tmp_path):
    stored = read_silver(spark, stored_layers(spark, sf_small).silver).filter(f"event_timestamp < '{AS_OF}'")
    flat = str(tmp_path / "silver")
    stored.coalesce(1).write.parquet(flat)
    stream = spark.readStream.schema(SILVER_SCHEMA).parquet(flat)
    start_kpi(stream, str(tmp_path / "kpi"), str(tmp_path / "checkpoint"), "1 day", "2 days").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "kpi"))
    latest = stored.agg(F.max("event_timestamp")).first()[0]
    closed = kpi_window(stored, "1 day").filter(
        F.col("window_end") <= F.lit(latest) - F.expr("INTERVAL 2 DAYS")
    )
    assert rows(got) == rows(closed) and got.count() > 50


def test_console_echo_sends_the_driver_no_more_rows_than_it_shows(spark, sf_small):
    echo = start_console(source(spark, sf_small), ALL_AVAILABLE)
    echo.awaitTermination()
    sent = sum(p.sink.numOutputRows for p in echo.recentProgress)
    assert read_events(spark, sf_small).count() > 20
    assert 0 < sent <= 20


def test_console_echo_still_reads_every_row_of_the_source(spark, sf_small, tmp_path):
    many = read_events(spark, sf_small)
    for n in range(6):  # more rows than one batch of the reader, in one file
        many = many.unionAll(read_events(spark, sf_small))
    many.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "events").mkdir()
    part = next((tmp_path / "written").glob("*.parquet"))
    (tmp_path / "events" / "events.parquet").write_bytes(part.read_bytes())
    echo = start_console(source(spark, str(tmp_path / "events")), ALL_AVAILABLE)
    echo.awaitTermination()
    progress = echo.recentProgress
    assert sum(p.numInputRows for p in progress) == 7 * read_events(spark, sf_small).count()
    assert 0 < sum(p.sink.numOutputRows for p in progress) <= 20
