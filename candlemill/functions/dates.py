"""Dates kept as ``yyyyMMdd`` text at the edges and as dates inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the stored text form of a date.
COMPACT = "yyyyMMdd"


def parse_compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text to a date; anything unreadable becomes NULL."""
    return F.try_to_date(text, COMPACT)


def compact_date(day: Column) -> Column:
    return F.date_format(day, COMPACT)


def years_before(day: Column, years: int) -> Column:
    return F.add_months(day, -12 * years)


def window_list(start: Column, end: Column, days: int, legacy_tail: bool = False) -> Column:
    """Cut ``[start, end]`` into consecutive windows of ``days`` days.

    Gives an array of ``struct(from, to)`` that covers both ends; the last
    window may be short, and ``start > end`` gives an empty array.  With
    ``legacy_tail`` a window only opens strictly before ``end``, so a range that
    would leave a final window of one day loses that day.
    """
    last_open = F.date_sub(end, 1) if legacy_tail else end
    opens = F.when(start <= last_open, F.sequence(start, last_open, F.expr(f"interval {int(days)} days")))
    opens = F.coalesce(opens, F.array().cast("array<date>"))
    return F.transform(
        opens,
        lambda first: F.struct(first.alias("from"), F.least(F.date_add(first, days - 1), end).alias("to")),
    )
