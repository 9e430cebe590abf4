"""Readers, writers and the batch job over real folders."""

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import AS_OF, kafka_records, read_events
from sluicebox.catalog.stored import stored_layers
from sluicebox.operators.bronze import to_bronze
from sluicebox.operators.routing import clean_rows, rejected_rows
from sluicebox.operators.silver import to_silver
from sluicebox.plans.refine import Targets, run_refine
from sluicebox.plans.report import build_report
from sluicebox.schemas import BRONZE_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from sluicebox.session import shared_folder
from sluicebox.sinks.fan_out import Sink, fan_out, held
from sluicebox.sinks.files import export_banks_csv, laid_out, write_csv, write_garbage, write_silver
from sluicebox.sources.layers import (
    LayerNotReady,
    read_bronze,
    read_csv_rows,
    read_garbage,
    read_garbage_if_any,
    read_required,
    read_silver,
)


@pytest.fixture(scope="module")
def layers(spark):
    return stored_layers(spark, "/root/testdata/sf0.001")


@pytest.fixture
def bronze(spark, sf_small):
    return to_bronze(kafka_records(read_events(spark, sf_small)))


def silver_rows(spark, values):
    """(transaction_id, bank_id, channel, quality_score) rows in the silver layout."""
    frame = spark.createDataFrame(values, "transaction_id string, bank_id string, channel string, quality_score string")
    fixed = {
        "event_timestamp": F.lit(AS_OF).cast("timestamp"), "amount": F.lit(1.5), "masked_card": F.lit(None).cast("string"),
        "status": F.lit(""), "processed_at": F.lit(AS_OF).cast("timestamp"),
    }
    return frame.withColumns(fixed).select(*SILVER_COLUMNS)


def test_bronze_columns_and_footer_schema(spark, layers):
    assert read_bronze(spark, layers.bronze).schema == BRONZE_SCHEMA
    assert read_bronze(spark, layers.bronze, schema=None).schema == BRONZE_SCHEMA


def test_bronze_is_found_in_subfolders(spark, bronze, tmp_path):
    for part in ("a/b", "c"):
        bronze.write.parquet(str(tmp_path / part))
    assert read_bronze(spark, str(tmp_path)).count() == 2 * bronze.count()


def test_numeric_bank_ids_and_null_channels_survive(spark, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(silver_rows(spark, [("1", "007", None, "CLEAN"), ("2", "42", "ATM", "CLEAN")]), path)
    back = read_silver(spark, path)
    assert back.schema.simpleString() == SILVER_SCHEMA.simpleString()
    assert {(r.transaction_id, r.bank_id, r.channel) for r in back.collect()} == {("1", "007", None), ("2", "42", "ATM")}


def test_null_fields_are_left_out_of_garbage_and_come_back(spark, tmp_path):
    path = tmp_path / "garbage"
    write_garbage(silver_rows(spark, [(None, None, None, "HARD_REJECT")]), str(path))
    (line,) = [json.loads(text) for file in path.glob("*.json") for text in file.open()]
    assert "transaction_id" not in line and "masked_card" not in line
    (row,) = read_garbage(spark, str(path)).collect()
    assert row.transaction_id is None and row.status == "" and row.quality_score == "HARD_REJECT"


def test_garbage_may_be_absent_or_empty(spark, tmp_path):
    absent = read_garbage_if_any(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    empty = read_garbage_if_any(spark, str(tmp_path / "empty"))
    write_garbage(silver_rows(spark, []), str(tmp_path / "written"))
    for frame in (absent, empty, read_garbage(spark, str(tmp_path / "written"))):
        assert frame.count() == 0 and frame.columns == SILVER_COLUMNS


def test_a_required_layer_that_is_missing_is_named(spark, layers, tmp_path):
    missing = str(tmp_path / "none")
    with pytest.raises(LayerNotReady, match="silver"):
        read_required(spark, layers.bronze, missing)
    with pytest.raises(LayerNotReady, match="bronze"):
        read_required(spark, missing, layers.silver)
    assert read_required(spark, layers.bronze, layers.silver)[1].columns == SILVER_COLUMNS
    (tmp_path / "empty").mkdir()
    with pytest.raises(LayerNotReady, match="bronze"):
        read_required(spark, str(tmp_path / "empty"), layers.silver)
    with pytest.raises(LayerNotReady, match="silver"):
        read_required(spark, layers.bronze, str(tmp_path / "empty"))


def test_empty_csv_still_has_a_header(spark, tmp_path):
    path = tmp_path / "csv"
    write_csv(silver_rows(spark, []), str(path))
    (file,) = path.glob("*.csv")
    assert file.read_text().strip() == ",".join(SILVER_COLUMNS)


def test_csv_replaces_the_previous_one_and_can_be_one_file(spark, tmp_path):
    path = tmp_path / "csv"
    rows = silver_rows(spark, [(str(i), "B", "ATM", "CLEAN") for i in range(50)]).repartition(4)
    write_csv(rows, str(path))
    assert len(list(path.glob("*.csv"))) == 4
    write_csv(rows, str(path), single_file=True)
    assert len(list(path.glob("*.csv"))) == 1
    back = read_csv_rows(spark, str(path))
    assert back.select("transaction_id", "amount").subtract(rows.select("transaction_id", "amount")).count() == 0
    first = next(path.glob("*.csv")).read_text().splitlines()[1]
    assert ',,"",CLEAN,' in first  # a null card is nothing, an empty status is quoted


def test_bank_export_is_named_after_its_minute(spark, layers, tmp_path):
    at = datetime(2026, 3, 4, 5, 6, 7)
    path = export_banks_csv(read_silver(spark, layers.silver), ["BANK_B"], str(tmp_path), at)
    assert Path(path).name == "cleaned_batch_20260304_0506.csv"
    banks = spark.read.option("header", "true").csv(path).select("bank_id").distinct().collect()
    assert [r.bank_id for r in banks] == ["BANK_B"]
    nothing = export_banks_csv(read_silver(spark, layers.silver), [], str(tmp_path / "none"), at)
    assert spark.read.option("header", "true").csv(nothing).count() == 0


@pytest.mark.parametrize("hold", ["table", "persist", "none"])
def test_batch_job_routes_every_row_once(spark, layers, bronze, tmp_path, hold):
    targets = Targets(str(tmp_path / "s"), str(tmp_path / "g"), csv=str(tmp_path / "c"))
    results = run_refine(spark, layers.bronze, targets, hold=hold)
    assert [(r.name, r.ok) for r in results] == [("silver", True), ("garbage", True), ("csv", True)]
    silver, garbage = read_silver(spark, targets.silver), read_garbage(spark, targets.garbage)
    csv = read_csv_rows(spark, targets.csv)
    assert silver.count() + garbage.count() == bronze.count()
    assert silver.count() == csv.count() == clean_rows(to_silver(bronze, AS_OF)).count()
    stamps = silver.unionAll(garbage).unionAll(csv).select("processed_at").distinct()
    assert stamps.count() == 1  # one processing time in all sinks


def test_no_card_text_in_any_output(spark, layers):
    stored = read_silver(spark, layers.silver).select(F.to_json(F.struct("*")).alias("value"))
    lines = stored.unionAll(spark.read.text(layers.garbage)).unionAll(spark.read.text(layers.csv))
    assert lines.count() > 1000 and lines.filter(F.col("value").contains("****")).count() == 0


def test_a_second_run_appends(spark, layers, tmp_path):
    targets = Targets(str(tmp_path / "s"), str(tmp_path / "g"), csv=str(tmp_path / "c"))
    for _ in range(2):
        run_refine(spark, layers.bronze, targets, AS_OF)
    assert read_silver(spark, targets.silver).count() == 2 * read_silver(spark, layers.silver).count()
    assert read_garbage(spark, targets.garbage).count() == 2 * read_garbage(spark, layers.garbage).count()
    once = spark.read.option("header", "true").csv(targets.csv).count()
    assert once == read_silver(spark, layers.silver).count()


def test_broker_failure_does_not_stop_the_files(spark, layers, tmp_path):
    targets = Targets(str(tmp_path / "s"), str(tmp_path / "g"), feed_servers="nowhere:1", csv=str(tmp_path / "c"))
    results = {r.name: r for r in run_refine(spark, layers.bronze, targets, AS_OF)}
    assert not results["feed"].ok and results["feed"].error
    assert results["csv"].ok and (tmp_path / "c").exists()


def test_required_sink_ends_the_run(spark):
    seen = []
    sinks = [Sink("first", lambda f: seen.append(1)), Sink("bad", lambda f: 1 / 0), Sink("last", lambda f: seen.append(2))]
    with pytest.raises(ZeroDivisionError):
        fan_out(spark.range(1), sinks)
    assert seen == [1]


def test_held_table_is_removed_and_read_by_label(spark, bronze):
    with held(to_silver(bronze, AS_OF)) as frame:
        (file, *_) = frame.inputFiles()
        assert frame.columns == SILVER_COLUMNS
        plan = rejected_rows(frame)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(quality_score" in plan
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(Path(file.removeprefix("file:")).parent.parent))


def test_unknown_options_are_refused(spark, bronze, tmp_path):
    with pytest.raises(ValueError):
        with held(bronze, "hope"):
            pass
    with pytest.raises(ValueError):
        write_silver(bronze, str(tmp_path / "x"), layout="hope")


def test_hot_bank_is_written_by_many_tasks(spark, tmp_path):
    """Nearly all rows share one bank and channel; the rebalance splits them."""
    rows = spark.range(300000).repartition(8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"), F.lit("BANK_A").alias("bank_id"),
        F.lit("ATM").alias("channel"), F.lit("CLEAN").alias("quality_score"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4m")
    try:
        write_silver(rows, str(tmp_path / "s"))
    finally:
        spark.conf.set(size, before)
    files = list((tmp_path / "s").glob("bank_id=BANK_A/channel=ATM/*.parquet"))
    assert len(files) >= 4
    assert spark.read.parquet(str(tmp_path / "s")).count() == 300000


def test_rebalancing_needs_adaptive_execution(spark, layers):
    frame = read_silver(spark, layers.silver)
    assert "Exchange" in laid_out(frame, ["bank_id"], "rebalance")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            laid_out(frame, ["bank_id"], "rebalance")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_texts_and_microseconds_survive_csv_and_json(spark, tmp_path):
    texts = [" a ", 'say "x", y', "two\nlines", "back\\slash", ""]
    rows = silver_rows(spark, [(str(i), "B", "ATM", "CLEAN") for i in range(len(texts))])
    at = F.lit("2026-01-01 00:00:00.123456").cast("timestamp")
    status = F.element_at(F.array(*[F.lit(t) for t in texts]), F.col("transaction_id").cast("int") + 1)
    rows = rows.withColumns({"status": status, "processed_at": at})
    write_csv(rows, str(tmp_path / "c"), single_file=True)
    write_garbage(rows, str(tmp_path / "g"))
    for back in (read_csv_rows(spark, str(tmp_path / "c")), read_garbage(spark, str(tmp_path / "g"))):
        assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_a_folder_for_intermediate_data_has_to_be_named(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda *a, **k: None)
    monkeypatch.setattr("sluicebox.session._folder", {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(spark, "x")


def test_report(spark, layers):
    report = build_report(spark, layers.bronze, layers.silver, layers.garbage)
    figures = report.figures.first()
    silver, garbage = read_silver(spark, layers.silver).count(), read_garbage(spark, layers.garbage).count()
    assert (figures.total_bronze, figures.total_silver, figures.total_garbage) == (silver + garbage, silver, garbage)
    assert figures.active_banks == 3 and figures.last_pulse == "00:00:00"
    assert figures.health_rate == silver / (silver + garbage) * 100
    banks = report.banks.collect()
    assert sum(r["count"] for r in banks) == silver and abs(sum(r.share for r in banks) - 1) < 1e-12


def test_report_on_empty_layers(spark, tmp_path):
    spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(str(tmp_path / "b"))
    silver_rows(spark, []).write.parquet(str(tmp_path / "s"))
    report = build_report(spark, str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "g"))
    figures = report.figures.first()
    assert (figures.total_bronze, figures.total_silver, figures.total_garbage) == (0, 0, 0)
    assert (figures.health_rate, figures.last_processed, figures.last_pulse) == (100.0, None, "N/A")
    assert report.banks.count() == 0


def test_aware_datetime_fixes_the_run(spark, layers, tmp_path):
    targets = Targets(str(tmp_path / "s"), str(tmp_path / "g"))
    run_refine(spark, layers.bronze, targets, datetime(2026, 1, 1, 2, tzinfo=timezone.utc))
    (row,) = read_silver(spark, targets.silver).select(F.col("processed_at").cast("string")).distinct().collect()
    assert row[0] == "2026-01-01 02:00:00"
