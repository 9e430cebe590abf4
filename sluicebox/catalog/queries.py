"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.catalog.fixtures import (
    AS_OF,
    EVENTS_SCHEMA,
    flat_texts,
    kafka_records,
    kafka_with_other_topics,
    read_events,
    structured_events,
)
from sluicebox.catalog.stored import TREE_SUFFIX, clustered_silver, stored_layers, stored_tree
from sluicebox.functions.quality import VALIDITY
from sluicebox.operators import flat, gold, metrics, sketches
from sluicebox.operators import runs as run_operators
from sluicebox.operators.bronze import matching_topics, to_bronze
from sluicebox.operators.decay import decayed_averages
from sluicebox.operators.feed import clean_feed, publish_frame, unroutable
from sluicebox.operators.lookup import of_cards, of_transactions
from sluicebox.operators.routing import clean_rows, rejected_rows, route_counts
from sluicebox.operators.silver import add_quality, flatten, parse_events, parse_once, to_silver
from sluicebox.plans.compact import compact, drop_replaced, folder_sizes
from sluicebox.plans.refine import Targets, run_refine
from sluicebox.plans.report import build_report
from sluicebox.schemas import BRONZE_SCHEMA, EVENT_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from sluicebox.session import shared_folder
from sluicebox.sinks.files import (
    export_banks_csv,
    write_csv,
    write_flat_garbage,
    write_flat_silver,
    write_garbage,
    write_silver,
)
from sluicebox.sources.flat_files import flat_folders, scan_flat_files
from sluicebox.sources.layers import (
    LayerNotReady,
    read_bronze,
    read_csv_rows,
    read_flat_garbage,
    read_flat_silver,
    read_garbage,
    read_garbage_if_any,
    read_required,
    read_silver,
)
from sluicebox.streaming.flat import start_flat
from sluicebox.streaming.ingest import ALL_AVAILABLE, run_ingest, start_bronze
from sluicebox.streaming.kpi import dated, start_kpi, start_undated
from sluicebox.streaming.refine import start_silver, stream_bronze
from sluicebox.streaming.repeats import start_without_repeats
from sluicebox.streaming.velocity import start_velocity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHOSEN_BANKS = ["BANK_A", "BANK_C"]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(kafka_records(read_events(spark, sf_dir)))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(_bronze(spark, sf_dir), AS_OF)


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, stored_layers(spark, sf_dir).silver)


def _comparable(frame: DataFrame) -> DataFrame:
    """Instants as plain UTC date-times."""
    times = [f.name for f in frame.schema if f.dataType.typeName() == "timestamp"]
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


# Ingestion


@query("topic_filter")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = matching_topics(kafka_with_other_topics(read_events(spark, sf_dir)))
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("bronze_ingest")
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = matching_topics(kafka_with_other_topics(read_events(spark, sf_dir)))
    return _comparable(to_bronze(records))


@query("bronze_stream")
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    base = shared_folder(spark, "bronze-stream")
    start_bronze(kafka_records(source), f"{base}/bronze", f"{base}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return _comparable(read_bronze(spark, f"{base}/bronze"))


@query("bronze_scan")
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(read_bronze(spark, stored_layers(spark, sf_dir).bronze))


# Parsing and typing


@query("schema_parse")
def schema_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_events(_bronze(spark, sf_dir), EVENT_SCHEMA)
    return parsed.select(
        F.col("offset").alias("event_id"),
        F.col("data.bank_id").alias("bank_id"),
        F.col("data.channel").alias("channel"),
        F.col("data.raw_payload.atmCode").alias("atm_code"),
        F.col("data.raw_payload.trxAmt").alias("trx_amt"),
        F.col("data.raw_payload.trxTime").alias("trx_time"),
        F.col("data.raw_payload.cardNumber").alias("card_number"),
        F.col("data.raw_payload.extra_field").cast("string").alias("extra_field"),
        F.col("data.ingest_time").alias("event_ingest_time"),
        F.col("data.source_event_id").alias("source_event_id"),
        F.col("data.extra_metadata.branch_id").alias("branch_id"),
        F.col("data.extra_metadata.device_status").alias("device_status"),
    )


@query("flatten")
def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(flatten(parse_events(_bronze(spark, sf_dir))))


@query("amount_cast")
def amount_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_once(_bronze(spark, sf_dir)).select("transaction_id", "amount")


@query("masked_card")
def masked_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("transaction_id", "masked_card")


@query("event_timestamp")
def event_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_scored(spark, sf_dir).select("transaction_id", "event_timestamp"))


# Scoring and routing


@query("quality_score")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_quality(parse_once(_bronze(spark, sf_dir))).select(
        "transaction_id", "amount", "bank_id", "status", "location", "quality_score"
    )


@query("quality_score_documented")
def quality_score_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_quality(parse_once(_bronze(spark, sf_dir)), VALIDITY).select(
        "transaction_id", "amount", "status", "quality_score"
    )


@query("silver_full")
def silver_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_scored(spark, sf_dir))


@query("silver_clean")
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(clean_rows(_scored(spark, sf_dir)))


@query("garbage_rejected")
def garbage_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(rejected_rows(_scored(spark, sf_dir)))


@query("route_counts")
def routed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(_scored(spark, sf_dir))


@query("clean_feed")
def clean_feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's JSON, parsed back; ``members`` counts the keys, as null fields have to be absent."""
    feed = clean_feed(_scored(spark, sf_dir))
    parsed = feed.withColumn("row", F.from_json("value", SILVER_SCHEMA))
    members = F.size(F.json_object_keys("value")).cast("bigint").alias("members")
    return _comparable(parsed.select("key", "row.*", members))


@query("publish_frame")
def publish_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic and parsed-back JSON of events on their way to the broker, all members."""
    return _published_members(publish_frame(structured_events(read_events(spark, sf_dir)), AS_OF), "topic")


@query("publish_named_topic")
def publish_named_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer that names its topic can publish every event."""
    records = publish_frame(structured_events(read_events(spark, sf_dir)), AS_OF, topic="bank_a_atm_transactions")
    return _published_members(records, "topic")


@query("publish_unroutable")
def publish_unroutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published_members(unroutable(structured_events(read_events(spark, sf_dir)), AS_OF))


def _published_members(records: DataFrame, *keep: str) -> DataFrame:
    parsed = records.withColumn("event", F.from_json("value", EVENT_SCHEMA))
    return parsed.select(
        *keep,
        F.col("event.source_event_id").alias("transaction_id"),
        F.col("event.bank_id").alias("bank_id"),
        F.col("event.channel").alias("channel"),
        F.col("event.raw_payload.atmCode").alias("atm_code"),
        F.col("event.raw_payload.trxAmt").alias("trx_amt"),
        F.col("event.raw_payload.trxTime").alias("trx_time"),
        F.col("event.raw_payload.cardNumber").alias("card_number"),
        F.col("event.raw_payload.extra_field").cast("string").alias("extra_field"),
        F.col("event.ingest_time").alias("event_ingest_time"),
        F.col("event.extra_metadata.branch_id").alias("branch_id"),
        F.col("event.extra_metadata.device_status").alias("status"),
        F.get_json_object("value", "$.event_timestamp").alias("published_at"),
    )


# Stored layers and exports


@query("silver_scan")
def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_stored_silver(spark, sf_dir))


@query("garbage_scan")
def garbage_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(read_garbage(spark, stored_layers(spark, sf_dir).garbage))


@query("silver_roundtrip")
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows appended in two writes, without the rebalancing shuffle, and read back."""
    path = shared_folder(spark, "silver")
    clean = clean_rows(_stored_silver(spark, sf_dir))
    write_silver(clean, path, layout="as_is")
    write_silver(clean, path, layout="as_is")
    return _comparable(read_silver(spark, path))


@query("garbage_roundtrip")
def garbage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows appended in two writes and read back."""
    path = shared_folder(spark, "garbage")
    rejected = rejected_rows(read_garbage(spark, stored_layers(spark, sf_dir).garbage))
    write_garbage(rejected, path)
    write_garbage(rejected, path)
    return _comparable(read_garbage(spark, path))


@query("garbage_optional")
def garbage_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a garbage layer that is there, and of one that is not."""
    garbage = stored_layers(spark, sf_dir).garbage
    return metrics.layer_counts(
        present=read_garbage_if_any(spark, garbage), absent=read_garbage_if_any(spark, f"{garbage}-absent")
    )


@query("csv_roundtrip")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(read_csv_rows(spark, stored_layers(spark, sf_dir).csv))


@query("csv_bank_export")
def csv_bank_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    silver = _stored_silver(spark, sf_dir)
    path = export_banks_csv(silver, CHOSEN_BANKS, shared_folder(spark, "export"), at)
    return _comparable(read_csv_rows(spark, path))


@query("csv_hard_texts")
def csv_hard_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks, quotes, commas, line breaks and microseconds through the one-file form of the export."""
    hard = F.concat(F.lit(' a "b", c\n'), F.coalesce("status", F.lit("")), F.lit(" "))
    instants = F.col("processed_at") + F.make_dt_interval(secs=F.lit(0.123456))
    rows = _stored_silver(spark, sf_dir).withColumns({"status": hard, "processed_at": instants})
    path = shared_folder(spark, "csv")
    write_csv(rows, path, single_file=True)
    return _comparable(read_csv_rows(spark, path))


@query("silver_stream_restart")
def silver_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checkpoints refine the same bronze into one layer: the second adds to what the first wrote."""
    base = shared_folder(spark, "silver-restart")
    silver, garbage = f"{base}/silver", f"{base}/garbage"
    for turn in (1, 1, 2):
        source = stream_bronze(spark, stored_layers(spark, sf_dir).bronze, 1)
        start_silver(source, silver, garbage, f"{base}/checkpoint-{turn}", as_of=AS_OF).awaitTermination()
    return _comparable(read_silver(spark, silver).unionAll(read_garbage(spark, garbage)).select(*SILVER_COLUMNS))


@query("silver_stream")
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the incremental job, read back."""
    base = shared_folder(spark, "silver-stream")
    silver, garbage = f"{base}/silver", f"{base}/garbage"
    source = stream_bronze(spark, stored_layers(spark, sf_dir).bronze)
    start_silver(source, silver, garbage, f"{base}/checkpoint", as_of=AS_OF).awaitTermination()
    sides = [
        frame.select(F.lit(layer).alias("layer"), *SILVER_COLUMNS)
        for layer, frame in (("silver", read_silver(spark, silver)), ("garbage", read_garbage(spark, garbage)))
    ]
    return _comparable(sides[0].unionAll(sides[1]))


@query("layers_compacted")
def layers_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layers of the incremental job before and after compaction, without the replaced folders, and after the job went on."""
    base = shared_folder(spark, "compacted")
    bronze, silver, garbage = f"{base}/bronze", f"{base}/silver", f"{base}/garbage"
    source = read_bronze(spark, stored_layers(spark, sf_dir).bronze)
    layers = ((silver, "parquet", read_silver), (garbage, "json", read_garbage))

    def refine(files: int) -> None:
        source.repartition(files, "offset").write.mode("append").parquet(bronze)
        start_silver(stream_bronze(spark, bronze, 1), silver, garbage, f"{base}/checkpoint", as_of=AS_OF).awaitTermination()

    def look(stage: str) -> None:
        for path, _, read in layers:
            rows = read(spark, path).select(F.lit(path.rsplit("/", 1)[1]).alias("layer"), F.lit(stage).alias("stage"), *SILVER_COLUMNS)
            rows.write.mode("append").parquet(f"{base}/seen")

    refine(6)
    look("before")
    for path, fmt, _ in layers:
        whole = folder_sizes(spark, path).agg(F.sum("bytes")).first()[0]
        if not compact(spark, path, f"{base}/checkpoint", fmt, whole // 3):
            raise AssertionError(f"nothing was due in {path}")
    look("compacted")
    for path, _, _ in layers:
        drop_replaced(spark, path)
    look("dropped")
    refine(1)
    look("continued")
    return _comparable(spark.read.parquet(f"{base}/seen"))


@query("fan_out_status")
def fan_out_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sink of a batch run, whether it succeeded, and its rows; the broker of the optional feed is away."""
    base = shared_folder(spark, "fan-out")
    targets = Targets(f"{base}/silver", f"{base}/garbage", feed_servers="nowhere:1", csv=f"{base}/csv")
    results = run_refine(spark, stored_layers(spark, sf_dir).bronze, targets, AS_OF)
    written = {
        "silver": read_silver(spark, targets.silver), "garbage": read_garbage(spark, targets.garbage),
        "csv": read_csv_rows(spark, targets.csv),
    }
    counts = metrics.layer_counts(**written).select(F.col("layer").alias("sink"), F.col("n").alias("rows"))
    states = spark.createDataFrame([(r.name, r.ok) for r in results], "sink STRING, ok BOOLEAN")
    return states.join(counts, "sink", "left").select("sink", "ok", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("report_figures")
def report_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitor's row over layers that have to be there."""
    layers = stored_layers(spark, sf_dir)
    return _comparable(build_report(spark, layers.bronze, layers.silver, layers.garbage).figures)


# Metrics


@query("layer_counts")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_layers(spark, sf_dir)
    return metrics.layer_counts(
        bronze=read_bronze(spark, stored.bronze),
        silver=read_silver(spark, stored.silver),
        garbage=read_garbage_if_any(spark, stored.garbage),
    )


@query("health_rate")
def health_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_layers(spark, sf_dir)
    return metrics.health_rate(read_bronze(spark, stored.bronze), read_silver(spark, stored.silver))


@query("bank_distribution")
def bank_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bank_distribution(_stored_silver(spark, sf_dir))


@query("bank_share")
def bank_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bank_share(_stored_silver(spark, sf_dir))


@query("freshness")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = metrics.freshness(_stored_silver(spark, sf_dir))
    return latest.withColumn("last_processed", F.col("last_processed").cast("timestamp_ntz"))


@query("distinct_banks")
def distinct_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_banks(_stored_silver(spark, sf_dir))


@query("bank_filter")
def bank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(metrics.of_banks(_stored_silver(spark, sf_dir), CHOSEN_BANKS))


@query("card_lookup")
def card_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a few cards, one of them unknown, from silver that is clustered by card."""
    return _comparable(of_cards(clustered_silver(spark, sf_dir), ["****1003", "****1008", "****1013", "****99999"]))


@query("transaction_lookup")
def transaction_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single transactions, which only bloom filters find in files clustered by card; one was rejected, one is unknown."""
    return _comparable(of_transactions(clustered_silver(spark, sf_dir), ["E2", "E40", "E94", "E412", "E3", "EX"]))


@query("masking_sample")
def masking_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.masking_sample(_stored_silver(spark, sf_dir), CHOSEN_BANKS, 10, ["transaction_id"])


@query("bronze_sample")
def bronze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(metrics.first_rows(read_bronze(spark, stored_layers(spark, sf_dir).bronze), 20, ["offset"]))


@query("silver_sample")
def silver_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = metrics.of_banks(_stored_silver(spark, sf_dir), CHOSEN_BANKS)
    return _comparable(metrics.first_rows(shown, 30, ["transaction_id"]))


# Flat events


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.add_issues(flat.parse_flat(flat_texts(read_events(spark, sf_dir))))


def _event_id() -> Column:
    return F.regexp_extract("file_name", "^e([0-9]+)", 1).cast("bigint").alias("event_id")


@query("flat_scan")
def flat_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a tree with one event per file: its folders, its transaction and its issues."""
    return _shown_files(flat.add_issues(flat.parse_flat(scan_flat_files(spark, stored_tree(spark, sf_dir), TREE_SUFFIX))))


def _shown_files(checked: DataFrame) -> DataFrame:
    return checked.select(
        "bank_dir", "channel_dir", F.try_variant_get("event.transaction_id", "$", "string").alias("transaction_id"),
        F.get_json_object("event_text", "$.note").alias("note"), F.array_join("issues", ",").alias("issues"),
    )


@query("flat_issues")
def flat_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(_event_id(), F.array_join("issues", ",").alias("issues"))


@query("flat_canonical")
def flat_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat.typed(flat.canonical(_checked(spark, sf_dir)))
    return rows.select(_event_id(), "transaction_id", "amount", "timestamp", "bank_id", "channel")


@query("flat_counts")
def flat_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a real tree per folder, among them a folder without any."""
    tree = stored_tree(spark, sf_dir)
    return flat.counts_per_folder(scan_flat_files(spark, tree, TREE_SUFFIX), flat_folders(spark, tree))


@query("flat_stream")
def flat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree as a stream over several batches, run twice with one checkpoint: each file once, in silver or with its issues."""
    tree, base = stored_tree(spark, sf_dir), shared_folder(spark, "flat-stream")
    size = max(1, spark.read.parquet(f"{sf_dir}/customer.parquet").count() // 3)
    for _ in range(2):
        start_flat(
            spark, tree, f"{base}/silver", f"{base}/garbage", f"{base}/checkpoint", suffix=TREE_SUFFIX, files_per_trigger=size
        ).awaitTermination()
    silver, garbage = read_flat_silver(spark, f"{base}/silver"), read_flat_garbage(spark, f"{base}/garbage")
    names = ["bank_dir", "channel_dir", "file_name"]
    kept = silver.select(*names, "transaction_id", F.lit("").alias("issues"))
    issues = garbage.groupBy(*names).agg(
        F.try_variant_get(F.try_parse_json(F.max("event_text")), "$.transaction_id", "string").alias("transaction_id"),
        F.array_join(F.sort_array(F.collect_list("issue")), ",").alias("issues"),
    )
    return kept.unionAll(issues).drop("file_name")


@query("flat_silver")
def flat_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events written per folder and read back."""
    path = shared_folder(spark, "flat-silver")
    write_flat_silver(flat.accepted(_checked(spark, sf_dir)), path)
    return _flat_rows(read_flat_silver(spark, path))


@query("flat_rerun")
def flat_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two disjoint sets of files, then the first again: each event is there once."""
    path = shared_folder(spark, "flat-rerun")
    rows = flat.accepted(_checked(spark, sf_dir))
    even = F.regexp_extract("file_name", "^e([0-9]+)", 1).cast("bigint") % 2 == 0
    for turn, part in enumerate((even, ~even, even)):
        write_flat_silver(rows.filter(part), path, run=f"{turn}")
    return _flat_rows(read_flat_silver(spark, path))


def _flat_rows(written: DataFrame) -> DataFrame:
    return written.select(
        _event_id(), "bank_dir", "channel_dir", "transaction_id", F.schema_of_variant("amount").rlike("BOOL").alias("is_bool"),
        F.try_variant_get("amount", "$", "double").alias("amount"), "timestamp", "bank_id", "channel",
    )


@query("flat_garbage")
def flat_garbage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copy per issue, written per folder and issue and read back."""
    path = shared_folder(spark, "flat-garbage")
    write_flat_garbage(flat.one_row_per_issue(_checked(spark, sf_dir)), path)
    return read_flat_garbage(spark, path).select(_event_id(), "bank_dir", "channel_dir", "issue", "event_text")


@query("flat_trailing_text")
def flat_trailing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text after a document, or a second one, makes the file no JSON, whatever the document says."""
    texts = flat_texts(read_events(spark, sf_dir))
    added = F.element_at(
        F.array(*[F.lit(x) for x in (" junk", "{}", ", {}", "] junk", "} junk", " \n")]), (_event_id() % 6 + 1).cast("int")
    )
    checked = flat.add_issues(flat.parse_flat(texts.withColumn("event_text", F.concat("event_text", added))))
    return checked.select(_event_id(), F.array_join("issues", ",").alias("issues"))


# Aggregates over silver


@query("kpi_window")
def kpi_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(gold.kpi_window(_stored_silver(spark, sf_dir), "1 day"))


def _with_extreme_amounts(silver: DataFrame) -> DataFrame:
    """Amounts that no decimal holds, by the number of the transaction."""
    number = F.substring("transaction_id", 2, 20).cast("bigint")
    amount = (
        F.when(number % 101 == 0, float("nan")).when(number % 103 == 0, float("inf")).when(number % 107 == 0, float("-inf"))
        .when(number % 13 == 1, 1e22).when(number % 13 == 2, 4e-7).otherwise(F.col("amount"))
    )
    return silver.withColumn("amount", amount)


def _shown_sum(column: str) -> Column:
    """NaN and infinities as text beside a number, as a comparison of doubles may treat them alike."""
    value = F.col(column)
    return F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == float("-inf"), "-inf").otherwise("number")


def _number(column: str) -> Column:
    return F.when(_shown_sum(column) == "number", F.col(column))


@query("kpi_window_extremes")
def kpi_window_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpi = gold.kpi_window(_with_extreme_amounts(_stored_silver(spark, sf_dir)), "1 day")
    shown = kpi.select("*", _shown_sum("total_amount").alias("kind"))
    return _comparable(shown.withColumn("total_amount", _number("total_amount")))


@query("velocity_extremes")
def velocity_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.velocity(_with_extreme_amounts(_stored_silver(spark, sf_dir)), 6 * 3600)
    shown = rows.select("*", _shown_sum("avg_amount_span").alias("kind"))
    return _comparable(shown.withColumn("avg_amount_span", _number("avg_amount_span")))


@query("velocity")
def velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(gold.velocity(_stored_silver(spark, sf_dir), 6 * 3600))


@query("garbage_alert")
def garbage_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(gold.garbage_alert(_scored(spark, sf_dir), 0.35, "1 hour"))


@query("garbage_incidents")
def garbage_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(run_operators.garbage_incidents(_scored(spark, sf_dir), 0.35, 3600))


@query("garbage_incidents_with_pauses")
def garbage_incidents_with_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two quiet windows do not end an incident; buckets of four windows, so that most incidents cross an edge."""
    return _comparable(run_operators.garbage_incidents(_scored(spark, sf_dir), 0.3, 1800, quiet_windows=2, bucket_windows=4))


@query("card_sessions")
def card_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(run_operators.card_sessions(_stored_silver(spark, sf_dir), 6 * 3600, 12 * 3600))


@query("decayed_averages")
def decayed_average_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To nine significant digits, as sums of doubles depend on their order."""
    rows = decayed_averages(_stored_silver(spark, sf_dir), 6 * 3600)
    digits = [F.round(c, 6).alias(c) for c in ("decayed_count", "decayed_average")]
    return _comparable(rows.select("masked_card", "event_timestamp", "txn_count", *digits))


@query("kpi_sketches")
def kpi_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and months per bank, merged from stored hours of two batches of silver; their estimates are held against silver.

    Beside each estimate stands the exact value, and whether the estimate is within four standard errors of it.
    """
    silver, path = _stored_silver(spark, sf_dir), shared_folder(spark, "hours")
    odd = F.substring("transaction_id", 2, 20).cast("bigint") % 2 == 1
    for batch in (silver.filter(odd), silver.filter(~odd)):
        sketches.hourly_states(batch).write.mode("append").parquet(path)
    days = sketches.per_period(spark.read.parquet(path), "day", "bank_id")
    months = sketches.per_period(days, "month", "bank_id")
    periods = [
        sketches.figures(states).withColumn("period", F.lit(name)) for name, states in (("day", days), ("month", months))
    ]
    estimated = periods[0].unionAll(periods[1])
    names = F.explode(F.array(F.lit("day"), F.lit("month"))).alias("period")
    rows = silver.select("*", names).withColumn("window_start", F.expr("date_trunc(period, event_timestamp)"))
    held = rows.join(estimated, ["period", "window_start", "bank_id"]).groupBy("period", "window_start", "bank_id").agg(
        F.first("txn_count").alias("txn_count"), F.first("total_amount").alias("total_amount"),
        F.first("distinct_cards").alias("estimate"), F.countDistinct("masked_card").alias("distinct_cards"),
        *[
            F.avg((F.col("amount") <= F.col("amount_quantiles")[i]).cast("double")).alias(f"rank_{i}")
            for i in range(2)
        ],
        *[
            F.avg((F.col("amount") < F.col("amount_quantiles")[i]).cast("double")).alias(f"below_{i}")
            for i in range(2)
        ],
    )
    near = [
        (F.col(f"rank_{i}") >= q - 0.027) & (F.col(f"below_{i}") <= q + 0.027) for i, q in enumerate((0.5, 0.95))
    ]
    return _comparable(held.select(
        "period", "window_start", "bank_id", "txn_count", "total_amount", "distinct_cards",
        (F.abs(F.col("estimate") - F.col("distinct_cards")) <= 0.065 * F.col("distinct_cards")).alias("cards_near"),
        near[0].alias("median_near"), near[1].alias("p95_near"),
    ))


@query("offset_audit")
def offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing ranges and repeats of a bronze layer in which some records were read twice; ranges of 1,000 offsets."""
    bronze = read_bronze(spark, stored_layers(spark, sf_dir).bronze)
    return run_operators.offset_audit(bronze.unionAll(bronze.filter(F.col("offset") % 97 == 0)), 1000)


# Streams over silver

ORDERED_PARTS = 4


def _time_ordered_silver(spark: SparkSession, sf_dir: str) -> str:
    """Dated silver rows as one file per part of their time, the oldest first, as a stream would have left them."""
    rows = dated(_stored_silver(spark, sf_dir))
    low, high = rows.agg(F.min(F.unix_micros("event_timestamp")), F.max(F.unix_micros("event_timestamp"))).first()
    path = shared_folder(spark, "ordered-silver")
    part = F.floor((F.unix_micros("event_timestamp") - low) * ORDERED_PARTS / (high - low + 1))
    for n in range(ORDERED_PARTS):
        rows.filter(part == n).coalesce(1).write.mode("append").parquet(path)
    return path


def _file_stream(spark: SparkSession, path: str, schema: str = SILVER_SCHEMA, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


@query("velocity_stream")
def velocity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card velocity from keyed state, over batches and one restart; rows up to the last hour that the watermark has passed."""
    source, base = _time_ordered_silver(spark, sf_dir), shared_folder(spark, "velocity-stream")
    for _ in range(2):
        start_velocity(
            _file_stream(spark, source), f"{base}/rows", f"{base}/checkpoint", 6 * 3600, "2 hours", 3600
        ).awaitTermination()
    return _comparable(spark.read.parquet(f"{base}/rows"))


@query("kpi_stream")
def kpi_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the stream that the watermark has passed."""
    source, base = _time_ordered_silver(spark, sf_dir), shared_folder(spark, "kpi-stream")
    start_kpi(_file_stream(spark, source), f"{base}/rows", f"{base}/checkpoint", "6 hours", "2 hours").awaitTermination()
    return _comparable(spark.read.parquet(f"{base}/rows"))


@query("kpi_undated")
def kpi_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a time of their own, which no window counts."""
    base = shared_folder(spark, "undated")
    start_undated(_file_stream(spark, stored_layers(spark, sf_dir).silver, files=1000), f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return _comparable(spark.read.schema(SILVER_SCHEMA).parquet(f"{base}/rows").select(*SILVER_COLUMNS))


@query("bronze_without_repeats")
def bronze_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze files, the same files again, and a second replay after a restart: every record is there once."""
    layers, base = stored_layers(spark, sf_dir), shared_folder(spark, "replayed")
    bronze = read_bronze(spark, layers.bronze)
    for run in range(2):
        for _ in range(2 - run):
            bronze.write.mode("append").parquet(f"{base}/replayed")
        source = _file_stream(spark, f"{base}/replayed", BRONZE_SCHEMA, 2)
        start_without_repeats(source, f"{base}/rows", f"{base}/checkpoint", within="400 days").awaitTermination()
    return _comparable(spark.read.schema(BRONZE_SCHEMA).parquet(f"{base}/rows"))


# Ingestion jobs


@query("bronze_timed_trigger")
def bronze_timed_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from micro-batches that a timer starts, until all that is there has been read."""
    source = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    base = shared_folder(spark, "bronze-timed")
    running = start_bronze(kafka_records(source), f"{base}/bronze", f"{base}/checkpoint", {"processingTime": "1 second"})
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _comparable(read_bronze(spark, f"{base}/bronze"))


@query("ingest_two_queries")
def ingest_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion job with its console echo, twice with one checkpoint: rows per topic."""
    source = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    base = shared_folder(spark, "ingest")
    for _ in range(2):
        run_ingest(spark, kafka_records(source), f"{base}/bronze", f"{base}/checkpoint", ALL_AVAILABLE, echo=True)
    return read_bronze(spark, f"{base}/bronze").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("health_text")
def health_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of clean rows as the monitor shows it."""
    stored = stored_layers(spark, sf_dir)
    row = metrics.health_rate(read_bronze(spark, stored.bronze), read_silver(spark, stored.silver)).first()
    shown = [(row["total_bronze"], row["total_silver"], metrics.percent_text(row["health_rate"]))]
    return spark.createDataFrame(shown, "total_bronze BIGINT, total_silver BIGINT, health STRING")


@query("layers_required")
def layers_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the layers that a report needs, where both are there; and the layer it names where silver is not."""
    stored = stored_layers(spark, sf_dir)
    bronze, silver = read_required(spark, stored.bronze, stored.silver)
    counts = metrics.layer_counts(bronze=bronze, silver=silver)
    try:
        read_required(spark, stored.bronze, f"{stored.silver}-absent")
    except LayerNotReady as error:
        return counts.withColumn("named_when_absent", F.lit(error.layer))
    raise AssertionError("a report was given a layer that is not there")
