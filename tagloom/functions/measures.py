"""Typed measures: money, day counts, score bands, ratios."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as decimals with ten places: exact, and the same in any row order.
MONEY_TYPE = "decimal(38,10)"
# Seconds of the first and the last day that a timestamp can show (years 1 to 9999).
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def money(amount: Column) -> Column:
    """Amount as an exact decimal; null for text that is not a number."""
    return amount.cast("string").try_cast(MONEY_TYPE)


def as_double(amount: Column) -> Column:
    """An exact amount as a double."""
    return amount.cast("double")


def today(as_of: date | str | None = None) -> Column:
    """The day a job counts from: `as_of`, or the day it runs."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_since_epoch_seconds(
    seconds: Column, as_of: date | str | None = None, shift_days: int = 0
) -> Column:
    """Days from the day of an epoch to `as_of` less `shift_days`.

    Null for an epoch beyond the years a timestamp can show, as of one in microseconds.
    """
    known = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    day = F.to_date(F.timestamp_seconds(known))
    return F.datediff(F.date_sub(today(as_of), shift_days), day)


def days_since_timestamp(
    moment: Column, as_of: date | str | None = None, shift_days: int = 0
) -> Column:
    """Days from the day of a timestamp to `as_of` less `shift_days`."""
    return F.datediff(F.date_sub(today(as_of), shift_days), F.to_date(moment))


def band_score(value: Column, bands: Sequence[tuple[float | None, float | None, int]]) -> Column:
    """Score of the first band holding `value`, null between bands."""
    score = F.lit(None).cast("int")
    for low, high, points in reversed(bands):
        inside = value.isNotNull()
        if low is not None:
            inside = inside & (value >= low)
        if high is not None:
            inside = inside & (value <= high)
        score = F.when(inside, F.lit(points)).otherwise(score)
    return score


def score_sum(*scores: str) -> Column:
    """Sum of banded scores."""
    total = F.col(scores[0])
    for name in scores[1:]:
        total = total + F.col(name)
    return total


def price_sensitivity(tdon: Column, ton: Column, tda: Column, tra: Column) -> Column:
    """Share of discounted orders + relative discount per order + share of money saved.

    Null where a divisor is 0.
    """
    order_share = F.try_divide(tdon, ton)
    per_order = F.try_divide(F.try_divide(tda, tdon), F.try_divide(tra, ton))
    return order_share + per_order + F.try_divide(tda, tra)


def majority_rule(total: Column, male: Column, female: Column, share: float) -> Column:
    """Rule code by share of votes: `0` male, `1` female, `-1` neither."""
    return (
        F.when(F.try_divide(male, total) >= share, F.lit("0"))
        .when(F.try_divide(female, total) >= share, F.lit("1"))
        .otherwise(F.lit("-1"))
    )
