"""The listing of securities: selection, daily snapshot, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.functions import is_blank
from candlemill.workspace import checkpointed

# What makes a listed security an ordinary share, and "no change".
CODE_LENGTH = 6
COMMON_CLASS = "0"
SHARE_GROUP = "ST"
UNCHANGED = "00"


def ordinary_shares(
    listing: DataFrame,
    code: str = "code",
    share_class: str = "share_class",
    group: str = "security_group",
    length: int = CODE_LENGTH,
    wanted_class: str = COMMON_CLASS,
    wanted_group: str = SHARE_GROUP,
) -> DataFrame:
    """Securities with a code of the right length that are common shares."""
    return listing.where(
        (F.length(code) == length) & (F.col(share_class) == wanted_class) & (F.col(group) == wanted_group)
    )


def fresh_snapshot(snapshot: DataFrame, source: DataFrame, as_of: str) -> DataFrame:
    """The snapshot when it was taken on ``as_of``, else the source taken anew.

    ``source`` lacks ``etldate`` and ``etlcheck``; a new snapshot starts with
    every code not done.  The choice is a scalar subquery of one plan.
    """
    taken = snapshot.select(F.max("etldate")).scalar()
    is_fresh = F.coalesce(taken == as_of, F.lit(False))
    renewed = source.select("*", F.lit(as_of).alias("etldate"), F.lit(None).cast("string").alias("etlcheck"))
    return snapshot.where(is_fresh).unionByName(renewed.where(~is_fresh))


def save_snapshot(snapshot: DataFrame, path: str) -> None:
    """Overwrite the JSON snapshot at ``path``, which ``snapshot`` may have been read from."""
    checkpointed(snapshot).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def pending(listing: DataFrame, status: str = "etlcheck") -> DataFrame:
    """Codes not processed yet."""
    return listing.where(is_blank(F.col(status)))


def split_pending(
    listing: DataFrame, status: str = "etlcheck", change: str = "price_change", unchanged: str = UNCHANGED
) -> tuple[DataFrame, DataFrame]:
    """Codes not processed yet: (no price change, price changed); an unknown change counts as one."""
    todo = pending(listing, status)
    same = F.col(change).eqNullSafe(unchanged)
    return todo.where(same), todo.where(~same)


def mark_done(listing: DataFrame, done: DataFrame, code: str, as_of: Column, status: str = "etlcheck") -> DataFrame:
    """Set the status of the processed codes to ``as_of``; codes compare as they are typed."""
    processed = done.select(code).distinct().withColumn("_done", F.lit(True))
    joined = listing.join(processed, code, "left")
    stamped = F.when(F.col("_done"), as_of).otherwise(F.col(status))
    return joined.select(*[stamped.alias(name) if name == status else F.col(name) for name in listing.columns])
