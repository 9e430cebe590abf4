"""Silver laid out for look-ups: rows of one card lie together, and each row group says which cards and transactions it may hold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluicebox.schemas import SILVER_PARTITIONS

CLUSTERED_BY = ("masked_card",)
BLOOM_COLUMNS = ("masked_card", "transaction_id")
_SPREAD = ("event_timestamp", "transaction_id")  # cuts a card that holds many rows over several files


def bloom_options(columns: tuple[str, ...] = BLOOM_COLUMNS) -> dict[str, str]:
    """Writer options: bloom filters as large as the distinct values of a row group ask for.

    Parquet leaves the filter out where a dictionary holds all values of a row group; readers then test the dictionary.
    """
    switched = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return switched | {"parquet.bloom.filter.adaptive.enabled": "true"}


def write_clustered_silver(clean: DataFrame, path: str, mode: str = "overwrite", parts: int | None = None) -> None:
    """Silver in its usual folders, range-partitioned and sorted by folder and card.

    Ranges come from a sample that Spark takes, and end with the time and the transaction, so that neither a hot bank nor a hot card
    (nor all rows without one) falls to one task. Without ``parts``, adaptive execution sizes the files as it does for other layers.
    Readers of silver read it unchanged.
    """
    keys = [*SILVER_PARTITIONS, *CLUSTERED_BY, *_SPREAD]
    ranged = clean.repartitionByRange(parts, *keys) if parts else clean.repartitionByRange(*keys)
    rows = ranged.sortWithinPartitions(*keys)
    rows.write.mode(mode).options(**bloom_options()).partitionBy(*SILVER_PARTITIONS).parquet(path)
