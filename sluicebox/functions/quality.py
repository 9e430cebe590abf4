"""Quality rule sets, held as data: ordered (label, condition) pairs over flattened columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicebox.constants import (
    CLEAN,
    DEVICE_WARNING,
    HARD_REJECT,
    INVALID_VALUE,
    MISSING_AMOUNT,
    WARNING_MISSING_CONTEXT,
)


def any_null(*names: str) -> Column:
    """True where at least one of the columns is null."""
    return reduce(Column.__or__, (F.col(name).isNull() for name in names))


@dataclass(frozen=True)
class RuleSet:
    """The first rule whose condition holds names the label; a row that meets none is clean."""

    name: str
    rules: tuple[tuple[str, Callable[[], Column]], ...]

    def score(self) -> Column:
        label = F.lit(CLEAN)
        for name, condition in reversed(self.rules):
            label = F.when(condition(), F.lit(name)).otherwise(label)
        return label


COMPLETENESS = RuleSet(
    "completeness",
    (
        (HARD_REJECT, lambda: any_null("transaction_id", "amount", "bank_id")),
        (WARNING_MISSING_CONTEXT, lambda: any_null("status", "location")),
    ),
)

# The labels of the written documentation: they also judge the amount's sign and the device.
VALIDITY = RuleSet(
    "validity",
    (
        (MISSING_AMOUNT, lambda: F.col("amount").isNull()),
        (INVALID_VALUE, lambda: F.col("amount") < 0),
        (DEVICE_WARNING, lambda: F.col("status") == "WARN"),
    ),
)


def is_clean() -> Column:
    return F.col("quality_score") == CLEAN


def is_rejected() -> Column:
    """Exact complement of :func:`is_clean`, as a score is never null."""
    return F.col("quality_score") != CLEAN
