"""Scalar feature expressions shared by the batch tables, the stream and scoring.

All are built-in column expressions. The clock functions work on epoch seconds,
so a session time zone other than UTC does not move an hour or a weekday.
Rounding is half-even where the original value was rounded by Python.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Seconds from 1970 to the fixed start of the transaction clock, 2017-11-30 UTC.
DATA_EPOCH = 1_512_000_000
# Rate used where a card or domain has no labelled history.
BASE_FRAUD_RATE = 0.035
LATE_NIGHT_ENDS = 6
DAY = 86_400


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def transaction_timestamp(offset: Column, epoch: int = DATA_EPOCH) -> Column:
    return F.timestamp_seconds(offset + F.lit(epoch))


def tx_hour(ts: Column) -> Column:
    return F.floor(F.pmod(F.unix_seconds(ts), F.lit(DAY)) / 3600).cast("bigint")


def tx_day_of_week(ts: Column) -> Column:
    """Monday is 0. The epoch began on a Thursday, day 3."""
    return F.pmod(F.floor(F.unix_seconds(ts) / DAY) + 3, F.lit(7)).cast("bigint")


def is_late_night(hour: Column) -> Column:
    return flag(hour < LATE_NIGHT_ENDS)


def log_tx_amt(amount: Column) -> Column:
    """NULL for an amount of -1 or less, where the logarithm does not exist."""
    return F.when(amount > -1, F.bround(F.ln(amount + 1), 4))


def amt_decimal_part(amount: Column) -> Column:
    """Signed distance to the nearest whole amount."""
    return F.bround(amount - F.bround(amount, 0), 4)


def amt_bucket(amount: Column) -> Column:
    return (
        F.when(amount < 50, "low")
        .when(amount < 200, "medium")
        .when(amount < 1000, "high")
        .when(amount >= 1000, "very_high")
    )


def is_blank(text: Column) -> Column:
    return flag(F.coalesce(text, F.lit("")) == "")


def is_mobile(device: Column) -> Column:
    return flag(device == "mobile")


def or_if_falsy(value: Column, default: Column) -> Column:
    """The default where the value is NULL or zero."""
    return F.when(F.coalesce(value, F.lit(0)) == 0, default).otherwise(value)


def zscore(amount: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the card's mean in deviations, safe for cards without a spread."""
    centre = or_if_falsy(mean, amount)
    spread = or_if_falsy(deviation, F.lit(1.0))
    return F.bround((amount - centre) / spread, 4)
