"""Look-ups of single cards and transactions. Equality reaches the Parquet reader, which skips row groups by range, dictionary and bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.functions.values import card_digest


def _any_of(column: str, values: Sequence[Column]) -> Column:
    # Single comparisons: a list beyond a few values would reach the reader as one range over all of them.
    return reduce(Column.__or__, [F.col(column) == value for value in values], F.lit(False))


def of_cards(silver: DataFrame, cards: Sequence[str]) -> DataFrame:
    """Rows of the given card numbers; no card gives no rows."""
    return silver.filter(_any_of("masked_card", [card_digest(F.lit(card)) for card in cards]))


def of_transactions(silver: DataFrame, transactions: Sequence[str]) -> DataFrame:
    """Rows of the given transactions; none gives no rows."""
    return silver.filter(_any_of("transaction_id", [F.lit(name) for name in transactions]))


def rows_scanned(frame: DataFrame) -> int:
    """Rows that the file scans of a frame have handed on in its last action, after row groups were skipped."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(n) for n in range(leaves.size())]
    return sum(scan.metrics().apply("numOutputRows").value() for scan in scans if scan.metrics().contains("numOutputRows"))
