"""Ratios that survive a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(value: Column, base: Column) -> Column:
    """``value / base * 100`` as a double; NULL where ``base`` is zero."""
    return F.try_divide(value.cast("double"), base.cast("double")) * 100
