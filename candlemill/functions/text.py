"""String helpers that replace row-at-a-time Python functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(path: Column, separator: str = "/") -> Column:
    """The part after the last separator, or the whole text without one."""
    return F.substring_index(path, separator, -1)


def clean_event_time(text: Column) -> Column:
    """``2024-05-19T14:00:01Z`` to a timestamp; unreadable text becomes NULL."""
    return F.try_to_timestamp(F.trim(F.regexp_replace(text, "[TZ]", " ")), F.lit("yyyy-MM-dd HH:mm:ss"))


def is_blank(text: Column) -> Column:
    """True for NULL and for empty text."""
    return F.coalesce(text, F.lit("")) == ""
