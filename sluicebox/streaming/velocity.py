"""Card velocity of a silver stream, from state per group of cards and time bucket."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal, localcontext
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sluicebox.functions.values import exact_amount, other_amount, whole_sum
from sluicebox.streaming.ingest import ALL_AVAILABLE
from sluicebox.streaming.kpi import dated

ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DIGITS = 60  # decimal(38, 18) and room for sums
DECIMALS = 18
CARD_GROUPS = 128  # part of the state's keys: another number needs a new checkpoint
PART_INSTANTS = 20_000  # in one entry of the state
SPAN_ROWS = (
    "masked_card STRING, bucket BIGINT, at BIGINT, txn_count BIGINT, txn_count_span BIGINT, amount_count_span BIGINT,"
    " exact_span DECIMAL(38,18), other_span STRING"  # as text, as NaN would become null on its way
)


class _Spans(StatefulProcessor):
    """Per group of cards and bucket: sums of each instant, of the bucket and of the one before, until the watermark has passed them.

    Each call and each entry of the state costs far more than a row, so a key holds the instants of many cards, and a batch adds
    them as a few entries. Timers lie at ends of ticks. When one fires, every row up to it has arrived or counts as late; the
    instants of the bucket up to the last tick that the watermark has passed, beyond those emitted before, are emitted. The timer at the
    bucket's end clears the state.
    """

    def __init__(self, span: int, tick: int) -> None:
        self.span, self.tick = span, tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", "instants STRING")
        self.emitted = handle.getValueState("emitted", "until BIGINT")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        _, bucket = key
        sums: dict[tuple[str, int], list] = {}
        with localcontext() as context:
            context.prec = DIGITS
            for frame in rows:
                columns = (frame[c].tolist() for c in ("masked_card", "at", "exact", "other", "is_other", "known"))
                for card, at, exact, other, is_other, known in zip(*columns, strict=True):
                    units = None if exact is None else int(exact.scaleb(DECIMALS))
                    _add(sums.setdefault((card, at), [0, 0, None, None]), 1, int(known), units, float(other) if is_other else None)
        held = [[card, at, *value] for (card, at), value in sums.items()]
        for start in range(0, len(held), PART_INSTANTS):
            self.parts.appendValue((json.dumps(held[start : start + PART_INSTANTS]),))
        for end in {at - at % self.tick + self.tick for _, at in sums if at >= bucket} | {bucket + self.span}:
            self.handle.registerTimer(end // 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        _, bucket = key
        expired = expiredTimerInfo.getExpiryTimeInMs() * 1000
        passed = timerValues.getCurrentWatermarkInMs() * 1000 - 1
        until = min(max(expired, passed - passed % self.tick), bucket + self.span)  # the batch's other timers find nothing left
        done = self.emitted.get()[0] if self.emitted.exists() else bucket
        if until > done:
            rows = self._rows(bucket, done, until)
            if len(rows):
                yield rows
            self.emitted.update((until,))
        if expired >= bucket + self.span:
            self.parts.clear()
            self.emitted.clear()

    def _rows(self, bucket: int, done: int, until: int) -> pd.DataFrame:
        """The instants from ``done`` up to ``until`` with the sums over the span that ends there."""
        cards: dict[str, dict[int, list]] = {}
        for (part,) in self.parts.get():
            for card, at, *value in json.loads(part):
                _add(cards.setdefault(card, {}).setdefault(at, [0, 0, None, None]), *value)
        found = []
        with localcontext() as context:
            context.prec = DIGITS
            for card, instants in cards.items():
                found += [(card, bucket, *row) for row in self._spans(sorted((at, *value) for at, value in instants.items()), done, until)]
        return pd.DataFrame(found, columns=[c.split()[0] for c in SPAN_ROWS.replace("(38,18)", "").split(", ")])

    def _spans(self, held: list[tuple], done: int, until: int) -> Iterator[tuple]:
        """Of one card's instants, those asked for."""
        odd = [(i, other) for i, (*_, other) in enumerate(held) if other is not None]
        places, others = [i for i, _ in odd], [other for _, other in odd]
        low = n = n_amount = exact = n_exact = 0
        for high, (at, n_at, n_amount_at, exact_at, _) in enumerate(held):
            n, n_amount = n + n_at, n_amount + n_amount_at
            if exact_at is not None:
                exact, n_exact = exact + exact_at, n_exact + 1
            while held[low][0] < at - self.span:
                n, n_amount = n - held[low][1], n_amount - held[low][2]
                if held[low][3] is not None:
                    exact, n_exact = exact - held[low][3], n_exact - 1
                low += 1
            if done <= at < until:
                in_span = others[bisect_left(places, low) : bisect_right(places, high)]
                yield at, n_at, n, n_amount, Decimal(exact).scaleb(-DECIMALS) if n_exact else None, repr(sum(in_span)) if in_span else None

    def close(self) -> None:
        pass


def _add(sums: list, n: int, n_amount: int, exact: int | None, other: float | None) -> None:
    sums[0] += n
    sums[1] += n_amount
    if exact is not None:
        sums[2] = exact if sums[2] is None else sums[2] + exact
    if other is not None:
        sums[3] = other if sums[3] is None else sums[3] + other


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that a query keeps from its start on, without leaving them to others."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def velocity_stream(silver: DataFrame, span_seconds: int = 3600, lateness: str = "2 hours", tick_seconds: int | None = None) -> DataFrame:
    """The rows of ``operators.gold.velocity`` for a stream, each once the watermark has passed its tick.

    As in the batch form, rows go to a bucket of one span and, as look-back, to the next one, so a card that holds most rows
    has a key per bucket. ``tick_seconds`` divides the span: shorter ticks show rows sooner. State is the card's sums per
    instant of the buckets that the watermark has not passed, under keys that ``CARD_GROUPS`` divide cards into. Rows older than the watermark are late: Spark drops them, so
    ``lateness`` has to cover the disorder of the input. Rows without a time of their own would move the watermark and are
    left to ``streaming.kpi.start_undated``.
    """
    tick_seconds = tick_seconds or span_seconds
    if span_seconds % tick_seconds:
        raise ValueError("ticks have to divide the span")
    span, tick = span_seconds * 1_000_000, tick_seconds * 1_000_000
    at = F.unix_micros("event_timestamp")
    home = at - F.pmod(at, F.lit(span))
    rows = dated(silver).filter(F.col("masked_card").isNotNull()).withWatermark("event_timestamp", lateness)
    spread = rows.select(
        "masked_card", "event_timestamp", at.alias("at"), exact_amount(F.col("amount")).cast("decimal(38,18)").alias("exact"),
        other_amount(F.col("amount")).alias("other"), other_amount(F.col("amount")).isNotNull().alias("is_other"),
        F.col("amount").isNotNull().alias("known"),
        F.pmod(F.xxhash64("masked_card"), F.lit(CARD_GROUPS)).alias("cards"),
        F.explode(F.array(home, home + F.lit(span))).alias("bucket"),
    )
    spans = spread.groupBy("cards", "bucket").transformWithStateInPandas(
        statefulProcessor=_Spans(span, tick), outputStructType=SPAN_ROWS, outputMode="append", timeMode="eventTime"
    )
    average = whole_sum(F.col("exact_span"), F.col("other_span").cast("double")) / F.nullif(F.col("amount_count_span"), F.lit(0))
    return spans.select(
        "masked_card", F.timestamp_micros("at").alias("event_timestamp"), "txn_count", "txn_count_span", average.alias("avg_amount_span")
    )


def start_velocity(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    span_seconds: int = 3600,
    lateness: str = "2 hours",
    tick_seconds: int | None = None,
    trigger: dict = ALL_AVAILABLE,
) -> StreamingQuery:
    """Append velocity rows to Parquet. State with timers needs the state store on disk, which this query takes for itself."""
    rows = velocity_stream(silver, span_seconds, lateness, tick_seconds)
    writer = rows.writeStream.outputMode("append").trigger(**trigger).queryName("velocity")
    with _settings(silver.sparkSession, ROCKS):
        return writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
