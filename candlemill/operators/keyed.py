"""Keyed relational operators: latest, top, subtract, insert-if-absent, delete.

Each one aggregates before it shuffles, so that a key holding a large share of
the rows shrinks on the map side; what still has to move with a hot key moves
through sort-merge joins, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this many rows per key, Spark's default lets a window limit them before its shuffle.
LIMITED_BEFORE_SHUFFLE = 1000
PARTS = 64


def match_keyed(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, also: Column | None = None
) -> DataFrame:
    """Join rows to a side that was aggregated by the same keys; NULL keys match nothing.

    Such a side arrives partitioned by the keys, so a plain join would not shuffle
    it again, and adaptive execution splits a hot key only where both sides are
    shuffled for the join.  ``<=>`` asks for that shuffle on either side (the
    right one has few rows per key).  A right side that measures small is still
    broadcast, without any shuffle.
    """
    renamed = {name: f"_right_{name}" for name in keys}
    other = right.na.drop(subset=list(keys)).withColumnsRenamed(renamed)
    condition = F.lit(True) if also is None else also
    for name, other_name in renamed.items():
        condition = condition & F.col(name).eqNullSafe(F.col(other_name))
    return left.join(other, condition, how).drop(*renamed.values())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that carry the largest ``order`` of their key (ties kept); NULL keys and orders drop out.

    One scan, and Spark limits the rows by rank before the shuffle.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    known = df.na.drop(subset=[*keys, order])
    return known.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_value_per_key(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """The high-water mark of each key."""
    return df.groupBy(*keys).agg(F.max(order).alias(name))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` must break all ties.

    Spark limits the rows per key before the shuffle, so a hot key sends at most
    ``n`` rows per map task.  It does so up to ``LIMITED_BEFORE_SHUFFLE``; for a
    larger ``n`` the first ``n`` of each of some parts of a key are found first.
    """
    if n > LIMITED_BEFORE_SHUFFLE:
        part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(PARTS))
        df = _ranked(df.withColumn("_part", part), [*keys, "_part"], order, n).drop("_part")
    return _ranked(df, keys, order, n)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows without an equal right row; left duplicates stay, NULL equals NULL."""
    other = right.select(*left.columns).distinct().alias("other")
    here = left.alias("here")
    condition = F.lit(True)
    for name in left.columns:
        condition = condition & F.col(f"here.`{name}`").eqNullSafe(F.col(f"other.`{name}`"))
    return here.join(other, condition, "left_anti")


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the same one: the smallest by the other columns."""
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    return _ranked(df, keys, [F.col(name) for name in rest], 1)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """The rows of ``batch`` to append: one per key, none with a key in ``target``.

    ``within`` names a key column, such as the day: only that range of the target
    which the batch spans is then read.  The batch is read once more for the two
    bounds, so it had better be a stored table.  The target's keys are as many as its rows and
    take little room in a file, so the hint keeps them from being broadcast.
    """
    if within is not None:
        low, high = batch.agg(F.min(within), F.max(within)).first()
        target = target.where(F.col(within).between(F.lit(low), F.lit(high)))
    return one_row_per_key(batch, keys).join(target.select(*keys).hint("merge"), list(keys), "left_anti")


def merged_ranges(ranges: DataFrame, key: str) -> DataFrame:
    """Overlapping or touching ``(key, from, to)`` date ranges joined into one.

    Only the longest range from each day matters, so the windows below see at
    most one row per key and day however many ranges come in.
    """
    by_start = Window.partitionBy(key).orderBy("from", "to")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("to").over(before)
    opens = F.when(reach.isNull() | (F.col("from") > F.date_add(reach, 1)), 1).otherwise(0)
    return (
        ranges.where("`from` <= `to`")
        .groupBy(key, "from")
        .agg(F.max("to").alias("to"))
        .withColumn("_opens", opens)
        .withColumn("_island", F.sum("_opens").over(by_start))
        .groupBy(key, "_island")
        .agg(F.min("from").alias("from"), F.max("to").alias("to"))
        .drop("_island")
    )


def delete_ranges(df: DataFrame, key: str, day: str, ranges: DataFrame) -> DataFrame:
    """``df`` without the rows of a key that fall in one of its date ranges."""
    gone = merged_ranges(ranges, key).withColumnsRenamed({"from": "_gone_from", "to": "_gone_to"})
    inside = F.col(day).between(F.col("_gone_from"), F.col("_gone_to"))
    return match_keyed(df, gone, [key], "left_anti", inside)


def keep_listed(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Rows whose key is in the listing."""
    return match_keyed(df, listed.select(key).distinct(), [key], "left_semi")


def drop_listed(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Rows whose key is not in the listing."""
    return match_keyed(df, listed.select(key).distinct(), [key], "left_anti")


def until_second_empty(windows: DataFrame, keys: Sequence[str], order: str, rows: str) -> DataFrame:
    """Windows read newest first until the second empty one; empty ones dropped.

    ``windows`` holds one row per key and calendar window, so the running count
    sees at most the windows of one key.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    empties = F.sum(F.when(F.col(rows) == 0, 1).otherwise(0)).over(
        newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return windows.withColumn("_empty", empties).where((F.col("_empty") <= 1) & (F.col(rows) > 0)).drop("_empty")
