"""Exact quantiles by narrowing brackets, without sorting a column.

A quantile is the value of a rank.  Each pass is one aggregate over all columns
and quantiles: a sketch gives two values that should enclose the rank, and the
next pass counts what lies below, at and between them.  The counts are exact, so
they say for certain on which side the rank is; the bracket narrows to that side
and the sketch goes on inside.  A bracket of a sketch with accuracy A holds about 4 / A of the
values before, so a trillion rows take four passes; when a bracket holds fewer than A values
the sketch is exact and the rank is met.  Only counts and brackets come to the driver:
a row per column and quantile.

NULL and NaN are no values.  Columns are taken as doubles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 2000


@dataclass(frozen=True)
class _Target:
    """A rank (from 1) among the values strictly between ``low`` and ``high``; None is no bound."""

    column: str
    quantile: float
    rank: int
    count: int
    low: float | None = None
    high: float | None = None
    pivots: tuple[float, float] | None = None
    found: float | None = None

    def inside(self) -> Column:
        """The column where it lies in the bracket."""
        value = _value(self.column)
        kept = F.lit(True)
        if self.low is not None:
            kept = kept & (value > F.lit(self.low))
        if self.high is not None:
            kept = kept & (value < F.lit(self.high))
        return F.when(kept, value)


def _value(name: str) -> Column:
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def rank_of(quantile: float, count: int) -> int:
    """The rank of the smallest value that at least this share of the values does not exceed."""
    return max(1, count - math.floor(count - quantile * count))


def _sketched(target: _Target, accuracy: int) -> Column:
    """Two values around the rank, by a sketch of the bracket."""
    share = target.rank / target.count
    slack = 2 / accuracy
    wanted = [max(0.0, share - slack), min(1.0, share + slack)]
    return F.percentile_approx(target.inside(), wanted, accuracy)


def _counted(target: _Target) -> Column:
    value, (a, b) = target.inside(), target.pivots
    return F.struct(
        F.count_if(value < F.lit(a)).alias("below"),
        F.count_if(value == F.lit(a)).alias("at_low"),
        F.count_if((value > F.lit(a)) & (value < F.lit(b))).alias("between"),
        F.count_if(value == F.lit(b)).alias("at_high"),
    )


def _narrowed(target: _Target, below: int, at_low: int, between: int, at_high: int) -> _Target:
    """The side of the pivots that holds the rank."""
    a, b = target.pivots
    rank = target.rank
    if rank <= below:
        return replace(target, high=a, count=below)
    if rank <= below + at_low:
        return replace(target, found=a)
    rank -= below + at_low
    if a < b:
        if rank <= between:
            return replace(target, low=a, high=b, rank=rank, count=between)
        if rank <= between + at_high:
            return replace(target, found=b)
        rank -= between + at_high
        return replace(target, low=b, rank=rank, count=target.count - below - at_low - between - at_high)
    return replace(target, low=a, rank=rank, count=target.count - below - at_low)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """``(column, quantile, value)``; the value is NULL where a column has no values.

    Two aggregates a pass over ``df``, which is best a stored table.
    """
    counts = df.agg(*[F.count(_value(name)).alias(f"_{at}") for at, name in enumerate(columns)]).first()
    every = [_Target(name, q, rank_of(q, counts[at]), counts[at]) for at, name in enumerate(columns) for q in quantiles]
    open_ones = {at: target for at, target in enumerate(every) if target.count}
    while open_ones:
        sketches = df.agg(*[_sketched(target, accuracy).alias(f"_{at}") for at, target in open_ones.items()]).first()
        open_ones = {at: replace(target, pivots=tuple(sketches[f"_{at}"])) for at, target in open_ones.items()}
        told = df.agg(*[_counted(target).alias(f"_{at}") for at, target in open_ones.items()]).first()
        for at, target in list(open_ones.items()):
            open_ones[at] = every[at] = _narrowed(target, *told[f"_{at}"])
            if every[at].found is not None:
                del open_ones[at]
    shape = T.StructType(
        [T.StructField("column", T.StringType()), T.StructField("quantile", T.DoubleType()), T.StructField("value", T.DoubleType())]
    )
    return df.sparkSession.createDataFrame([(t.column, float(t.quantile), t.found) for t in every], shape)
