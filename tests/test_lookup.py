"""Silver clustered for look-ups: the same rows, and the share of them that a look-up reads."""

import hashlib

from pyspark.sql import functions as F

from sluicebox.operators.lookup import of_cards, of_transactions, rows_scanned
from sluicebox.schemas import SILVER_COLUMNS, SILVER_SCHEMA
from sluicebox.sinks.clustered import write_clustered_silver
from sluicebox.sources.layers import read_silver

ROWS, CARDS, PARTS = 40_000, 997, 32


def silver_rows(spark):
    """Every third row has the one hot card, every fiftieth none; three banks of two channels."""
    n = F.col("id")
    card = F.when(n % 50 == 7, F.lit(None)).when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.hash("id") % CARDS).cast("string")))
    rows = spark.range(ROWS).withColumns({
        "transaction_id": F.concat(F.lit("E"), n.cast("string")), "event_timestamp": F.timestamp_seconds(1_700_000_000 + n),
        "bank_id": F.concat(F.lit("BANK_"), (n % 3).cast("string")), "channel": F.when(n % 4 < 3, "ATM").otherwise("WEB"),
        "amount": n.cast("double"), "masked_card": F.sha2(card, 256), "status": F.lit("OK"), "quality_score": F.lit("CLEAN"),
        "processed_at": F.timestamp_seconds(F.lit(1_800_000_000)),
    })
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SILVER_SCHEMA])


def keyed(frame):
    return sorted(tuple(r) for r in frame.select("transaction_id", "masked_card", "bank_id", "channel", "amount").collect())


def test_clustered_silver_holds_the_same_rows(spark, tmp_path):
    rows = silver_rows(spark)
    write_clustered_silver(rows, str(tmp_path / "s"), parts=PARTS)
    stored = read_silver(spark, str(tmp_path / "s"))
    assert stored.columns == SILVER_COLUMNS
    assert sorted(map(repr, keyed(stored))) == sorted(map(repr, keyed(rows)))


def test_a_hot_card_is_spread_over_files(spark, tmp_path):
    write_clustered_silver(silver_rows(spark), str(tmp_path / "s"), parts=PARTS)
    hot = read_silver(spark, str(tmp_path / "s")).filter(F.col("masked_card") == hashlib.sha256(b"hot").hexdigest())
    sizes = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == sum(n % 3 == 0 and n % 50 != 7 for n in range(ROWS))
    assert max(sizes) < 3 * ROWS / PARTS


def test_lookups_read_a_small_share(spark, tmp_path):
    rows = silver_rows(spark)
    write_clustered_silver(rows, str(tmp_path / "s"), parts=PARTS)
    silver = read_silver(spark, str(tmp_path / "s"))
    card = of_cards(silver, ["c5"])
    assert keyed(card) == keyed(of_cards(rows, ["c5"])) != []
    card.collect()
    assert rows_scanned(card) < 0.3 * ROWS  # six folders, one or two files of each
    one = of_transactions(silver, ["E77", "E4001"])
    assert [r.transaction_id for r in one.orderBy("amount").collect()] == ["E77", "E4001"]
    one.collect()
    assert rows_scanned(one) < 0.15 * ROWS
    unknown = of_cards(silver, ["no such card"])
    assert unknown.collect() == [] and rows_scanned(unknown) < 0.1 * ROWS


def test_nothing_asked_and_empty_layers(spark, tmp_path):
    rows = silver_rows(spark)
    assert of_cards(rows, []).count() == 0 and of_transactions(rows, []).count() == 0
    write_clustered_silver(rows.limit(0), str(tmp_path / "e"))
    empty = spark.read.schema(SILVER_SCHEMA).parquet(str(tmp_path / "e"))
    assert of_cards(empty, ["c5"]).count() == 0
