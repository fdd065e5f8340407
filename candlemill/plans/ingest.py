"""Ingestion of daily prices: plan, rebase detection, append, purge."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions import window_list, years_before
from candlemill.operators.keyed import (
    delete_ranges,
    drop_listed,
    insert_ignore,
    keep_listed,
    last_value_per_key,
    match_keyed,
)

# Days per request, years of history kept, first day of other plans.
WINDOW_DAYS = 30
HISTORY_YEARS = 10
FIRST_DAY_TABLE = datetime.date(2000, 1, 1)
FIRST_DAY_FILES = datetime.date(1985, 1, 1)


def request_start(last_day: Column, listed_day: Column, as_of: Column, years: int = HISTORY_YEARS) -> Column:
    """The last stored day, else the listing day but no earlier than the history kept."""
    return F.coalesce(last_day, F.greatest(listed_day, years_before(as_of, years)))


def next_day_start(last_day: Column, first_day: datetime.date = FIRST_DAY_TABLE) -> Column:
    """The older rule: the day after the last stored one, else a fixed first day."""
    return F.coalesce(F.date_add(last_day, 1), F.lit(first_day))


def cut_windows(starts: DataFrame, start: str, end: Column, days: int = WINDOW_DAYS, legacy_tail: bool = False):
    """One row per window: the columns of ``starts`` (but ``start``) plus ``from`` and ``to``."""
    kept = [F.col(name) for name in starts.columns if name != start]
    return starts.select(*kept, F.inline(window_list(F.col(start), end, days, legacy_tail)))


def plan_windows(
    listing: DataFrame,
    prices: DataFrame,
    as_of: datetime.date,
    code: str = "code",
    day: str = "day",
    listed_day: str = "listed_day",
    days: int = WINDOW_DAYS,
) -> DataFrame:
    """``(code, from, to)`` requests that bring every listed code up to ``as_of``.

    The first window of a stored code starts on its last stored day, the overlap
    that ``rebased_codes`` compares.  A code already stored on ``as_of`` would
    only ask for that day again, so it gets no window.
    """
    today = F.lit(as_of)
    last = last_value_per_key(prices, [code], day, "_last")
    starts = listing.select(code, listed_day).join(last, code, "left")
    starts = starts.withColumn("_start", request_start(F.col("_last"), F.col(listed_day), today))
    windows = cut_windows(starts.select(code, "_last", "_start"), "_start", today, days)
    return windows.where(F.col("_last").isNull() | (F.col("to") != F.col("_last"))).drop("_last")


def rebased_codes(fetched: DataFrame, stored: DataFrame, code: str, day: str, price: str) -> DataFrame:
    """Codes whose fetched price differs from the stored one on the same day.

    Rows meet rows here, so neither side is ever broadcast.
    """
    old = stored.select(code, day, F.col(price).alias("_old"))
    both = fetched.select(code, day, price).join(old.hint("merge"), [code, day])
    return both.where(F.col(price) != F.col("_old")).select(code).distinct()


def without_rebased(prices: DataFrame, rebased: DataFrame, code: str) -> DataFrame:
    """Drop the whole history of rebased codes; ``plan_windows`` then refetches it."""
    return drop_listed(prices, code, rebased)


def without_overlap(arrays: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the last element of each parallel array.

    Responses run from the newest day to the oldest, so that is the overlap day.
    """
    trimmed = {name: F.slice(name, F.lit(1), F.greatest(F.size(name) - 1, F.lit(0))) for name in columns}
    return arrays.withColumns(trimmed)


def arrays_to_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parallel arrays of a response to one row per position."""
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.arrays_zip(*columns)))


def price_rows(responses: DataFrame, columns: list[str], days: str) -> DataFrame:
    """Responses to price rows: overlap dropped, arrays opened, records without a day dropped."""
    return arrays_to_rows(without_overlap(responses, columns), columns).where(F.col(days).isNotNull())


def new_prices(target: DataFrame, batch: DataFrame, code: str = "code", day: str = "day") -> DataFrame:
    """The rows of a batch to append; running it again appends nothing.

    Only the days that the batch spans are read of the target.
    """
    return insert_ignore(target, batch, [code, day], within=day)


def purge_delisted(prices: DataFrame, listing: DataFrame, code: str) -> DataFrame:
    """Prices of codes that are still listed."""
    return keep_listed(prices, code, listing)


def purge_old(prices: DataFrame, day: str, as_of: datetime.date, years: int = HISTORY_YEARS) -> DataFrame:
    """Prices within the history kept; the cutoff is a literal, so it reaches the scan."""
    return prices.where(F.col(day) >= years_before(F.lit(as_of), years))


def purge_range(prices: DataFrame, ranges: DataFrame, code: str, day: str) -> DataFrame:
    """Prices outside the ``(code, from, to)`` ranges."""
    return delete_ranges(prices, code, day, ranges)


def rows_after_stored(fetched: DataFrame, stored: DataFrame, code: str, day: str) -> DataFrame:
    """Fetched rows later than the last stored day of their code."""
    last = last_value_per_key(stored, [code], day, "_last")
    joined = match_keyed(fetched, last, [code], "left")
    return joined.where(F.col("_last").isNull() | (F.col(day) > F.col("_last"))).select(*fetched.columns)
