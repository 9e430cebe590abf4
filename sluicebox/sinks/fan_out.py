"""One scored frame to several sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from sluicebox.session import delete_folder, shared_folder

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Sink:
    """A named write. When an optional one fails, the failure is logged and the next sinks still run."""

    name: str
    write: Callable[[DataFrame], None]
    required: bool = True


@dataclass(frozen=True)
class SinkResult:
    name: str
    ok: bool
    error: str | None = None


@contextmanager
def held(frame: DataFrame, how: str = "table", route: str = "quality_score") -> Iterator[DataFrame]:
    """The frame in a form that several writes can read without scanning and parsing the input again.

    ``table`` writes it once to the shared folder, partitioned by the column that routes its rows: each
    sink reads only its own part, and a lost executor costs no parsing. ``persist`` keeps it on the
    executors, which suits small runs. ``none`` recomputes it per sink, which pays when there is just one.
    """
    if how == "none":
        yield frame
    elif how == "persist":
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield frame
        finally:
            frame.unpersist()
    elif how == "table":
        spark = frame.sparkSession
        path = shared_folder(spark, "held")
        try:
            frame.write.partitionBy(route).parquet(path)
            yield spark.read.schema(frame.schema).parquet(path).select(*frame.columns)
        finally:
            delete_folder(spark, path)
    else:
        raise ValueError(f"unknown way to hold a frame: {how!r}")


def fan_out(frame: DataFrame, sinks: Sequence[Sink]) -> list[SinkResult]:
    """Run the sinks in order. A required one that fails ends the run with its own error."""
    results = []
    for sink in sinks:
        try:
            sink.write(frame)
        except Exception as error:
            if sink.required:
                raise
            log.warning("optional sink %s failed: %s", sink.name, error)
            results.append(SinkResult(sink.name, False, str(error)))
        else:
            results.append(SinkResult(sink.name, True))
    return results
