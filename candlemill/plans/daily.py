"""The daily run: plan, fetch, detect rebased codes, refetch them, append, mark done.

    listing ──> requests ──> fetch ──> rebased? ──> requests ──> fetch
                                          │                        │
    stored prices ── minus rebased ───────┴────────> new rows <────┘

Both fetches are written tables (see ``fetch_windows``), so everything after
them reads files and nothing is fetched twice; the codes found to be rebased are
written too, as several results need them.

A failed request never leaves a hole.  The next run starts at the last stored
day, so rows of a code count only up to its first failed window; a rebased code
keeps its old history until its new one came back whole.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions import compact_date
from candlemill.operators.keyed import drop_listed, match_keyed
from candlemill.plans.ingest import new_prices, plan_windows, rebased_codes, without_rebased
from candlemill.plans.listing import mark_done, pending, split_pending
from candlemill.workspace import written

# Requests ``(code, from, to)`` to ``(price rows, errors with columns code and from)``.
FetchFrames = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def before_failures(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """The fetched rows of each code that are earlier than its first failed window."""
    first = errors.groupBy("code").agg(F.min(F.col("from").cast("date")).alias("_failed"))
    joined = match_keyed(rows, first, ["code"], "left")
    return joined.where(F.col("_failed").isNull() | (F.col("day") < F.col("_failed"))).drop("_failed")


@dataclass(frozen=True)
class DailyUpdate:
    """What a daily run has to store."""

    rebased: DataFrame  # codes with a whole new history: what is stored of them is void
    kept: DataFrame  # stored prices that stay
    added: DataFrame  # price rows to append to them
    errors: DataFrame  # requests that failed; their codes stay pending
    listing: DataFrame  # the listing with the finished codes marked


def daily_update(
    listing: DataFrame, stored: DataFrame, fetch: FetchFrames, as_of: datetime.date, price: str = "close"
) -> DailyUpdate:
    """One run over all pending codes.

    ``listing`` has ``code, listed_day, price_change, etlcheck`` and ``stored``
    one row per ``code, day``.  A code is rebased when the listing says its price
    basis changed, or when the overlap day comes back with another price; its
    whole history is fetched again.  A code with a failed request stays pending.
    """
    todo = pending(listing)
    announced = split_pending(listing)[1].select("code")
    trusted = without_rebased(stored, announced, "code")

    rows, errors = fetch(plan_windows(todo, trusted, as_of))
    found = written(rebased_codes(rows, trusted, "code", "day", price), "rebased")
    again = todo.join(found, "code", "left_semi")
    rows_again, errors_again = fetch(plan_windows(again, stored.limit(0), as_of))

    # What a code's second fetch brought replaces its first.
    failed = drop_listed(errors, "code", found).unionByName(errors_again)
    failed_codes = failed.select("code").distinct()
    changed = announced.unionByName(found)
    rebased = drop_listed(changed, "code", failed_codes)
    kept = without_rebased(stored, rebased, "code")
    unchanged = drop_listed(before_failures(rows, errors), "code", changed)
    renewed = drop_listed(drop_listed(rows, "code", found).unionByName(rows_again), "code", failed_codes)
    # Stored, as its first and last day are asked for before its rows.
    fetched = written(unchanged.unionByName(renewed.join(rebased, "code", "left_semi")), "new")
    finished = drop_listed(todo.select("code"), "code", failed_codes)
    return DailyUpdate(
        rebased=rebased,
        kept=kept,
        added=new_prices(kept, fetched),
        errors=failed,
        listing=mark_done(listing, finished, "code", compact_date(F.lit(as_of))),
    )
