"""Evaluating a costly expression exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """``frame.withColumn(name, value)`` in a form that later filters cannot multiply.

    Catalyst pushes a filter on a computed column below the computation. For fields of parsed JSON that
    parses every text again for each field the filter tests. A filter on the columns of a generator
    stays above it; this generator emits exactly one row per input row, also where the value is null.
    """
    return frame.select("*", F.inline(F.array(F.struct(value.alias(name)))))
