"""Expressions that turn event text into typed silver values without failing on dirty input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicebox.constants import CARD_DIGEST_BITS, TRANSACTION_TIME_PATTERNS


def amount_of(text: Column) -> Column:
    """Double value of a text, null where it is none (plain casts raise under ANSI rules)."""
    return text.try_cast("double")


def instant(as_of: datetime | str | Column | None) -> Column:
    """The processing time: the query's own clock, or a fixed instant for reproducible runs."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        if as_of.tzinfo is None:
            raise ValueError("as_of needs a time zone; a naive datetime means another instant on every host")
        as_of = as_of.isoformat()
    return F.lit(as_of).cast("timestamp")


def event_time_of(text: Column, fallback: Column) -> Column:
    """Time of the first pattern that fits; text that fits none takes the fallback.

    A failed parse raises and catches an exception inside Spark, which costs more than the parse. The
    third character tells the patterns apart, so most rows try only the one that can succeed.
    """
    slashed, dashed = (F.try_to_timestamp(text, F.lit(pattern)) for pattern in TRANSACTION_TIME_PATTERNS)
    parsed = F.when(F.substring(text, 3, 1) == "/", slashed).otherwise(dashed)
    return F.coalesce(parsed, fallback)


def card_digest(card: Column) -> Column:
    """Hex digest in place of the card number. Few distinct inputs exist, so it is no anonymisation."""
    return F.sha2(card, CARD_DIGEST_BITS)


def topic_name(bank_id: Column, channel: Column) -> Column:
    """Input topic of a bank and channel, such as bank_a_atm_transactions."""
    return F.concat(F.lower(bank_id), F.lit("_"), F.lower(channel), F.lit("_transactions"))


def utc_iso_text(ts: Column) -> Column:
    """ISO text of an instant in UTC with microseconds, whatever the session time zone is.

    The fraction is left out when it is zero, as producers do.
    """
    utc = F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz"))
    fraction = F.date_format(utc, ".SSSSSS")
    return F.concat(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction != ".000000", fraction).otherwise("")
    )


EXACT_BELOW = 1e12


def exact_amount(amount: Column) -> Column:
    """Decimal value of amounts below 1e12 that 18 decimals hold exactly, null for all others.

    Sums of these do not depend on the order of rows or on task retries. What is null here is in ``other_amount``.
    """
    decimal = amount.try_cast("decimal(38,18)")
    return F.when((F.abs(amount) < EXACT_BELOW) & (decimal.cast("double") == amount), decimal)


def other_amount(amount: Column) -> Column:
    """The amounts that ``exact_amount`` leaves out, as doubles: NaN, infinities, very large or very fine values."""
    return F.when(exact_amount(amount).isNull(), amount)


def whole_sum(exact: Column, other: Column) -> Column:
    """The sum of both parts as a double; null only where there was no amount at all."""
    return F.when(
        exact.isNotNull() | other.isNotNull(), F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(other, F.lit(0.0))
    )
