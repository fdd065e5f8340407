"""The keys with the largest totals, exactly, without counting all keys.

Round one: every task keeps a bounded summary of its rows.  When it has more
than twice ``capacity`` keys, all totals are reduced by that of the ``capacity + 1``-th and
keys that reach zero go; what was taken off a key is at most the sum of these
reductions, the summary's error.  Over all tasks a key's total lies between its
summed count and that plus the summed errors.  The k-th largest lower bound is a threshold that the
answer cannot be below.

Round two: rows of the keys that could reach the threshold, and of no others, are totalled exactly.
If the threshold is not above the error, as where all keys are about equally
frequent, the summaries exclude nothing; all keys are then totalled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.workspace import written

#: Keys that the summary of a task keeps, and candidates that are sent to every task in round two.
CAPACITY = 4096
SENT_TO_ALL = 100_000
_KEY, _WEIGHT, _ERROR = "_key", "_weight", "_error"


def _merged(keys: pa.Array, weights: pa.Array) -> pa.Table:
    return pa.table({_KEY: keys, _WEIGHT: weights}).group_by(_KEY).aggregate([(_WEIGHT, "sum")]).rename_columns([_KEY, _WEIGHT])


def summarised(capacity: int):
    """From batches of (key, weight) to at most ``2 * capacity`` rows (key, count) and one (NULL, error)."""

    def reduced(table: pa.Table) -> tuple[pa.Table, int]:
        """Totals less the ``capacity + 1``-th of them, and how much that was."""
        weights = table[_WEIGHT].to_numpy()
        off = int(np.partition(weights, len(weights) - capacity - 1)[len(weights) - capacity - 1])
        kept = table.filter(pc.greater(table[_WEIGHT], off))
        return kept.set_column(1, _WEIGHT, pc.subtract(kept[_WEIGHT], off)), off

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error = None, 0
        for batch in batches:
            more = pa.table({_KEY: batch.column(0), _WEIGHT: batch.column(1)})
            if held is not None:
                more = pa.concat_tables([held, more])
            held = _merged(more[_KEY], more[_WEIGHT])
            if held.num_rows > 2 * capacity:
                held, off = reduced(held)
                error += off
        if held is not None:
            told = pa.table({_KEY: pa.array([None], pa.string()), _WEIGHT: pa.array([error], pa.int64())})
            yield from pa.concat_tables([held, told]).combine_chunks().to_batches()

    return summarise


def _encoded(keys: Sequence[str]) -> Column:
    """The key columns as one text that is never NULL."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def heavy_candidates(df: DataFrame, keys: Sequence[str], n: int, weight: Column, capacity: int) -> tuple[DataFrame | None, int]:
    """Keys (encoded) that can be among the ``n`` largest, and their number; (None, 0) where none can be excluded."""
    pairs = df.select(_encoded(keys).alias(_KEY), weight.cast("long").alias(_WEIGHT)).where(F.col(_WEIGHT) > 0)
    parts = written(pairs.mapInArrow(summarised(capacity), f"{_KEY} string, {_WEIGHT} long"), "summaries")
    error = parts.where(F.col(_KEY).isNull()).agg(F.coalesce(F.sum(_WEIGHT), F.lit(0))).first()[0]
    counts = parts.where(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(F.sum(_WEIGHT).alias(_WEIGHT))
    largest = counts.select(_WEIGHT).orderBy(F.desc(_WEIGHT)).limit(n).agg(F.count("*"), F.min(_WEIGHT)).first()
    threshold = largest[1] if largest[0] == n else 0
    if threshold <= error:
        return None, 0
    found = written(counts.where(F.col(_WEIGHT) + error >= threshold).select(_KEY), "candidates")
    return found, found.count()


def top_keys(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    weight: Column | None = None,
    name: str = "n",
    capacity: int = CAPACITY,
) -> DataFrame:
    """The ``n`` keys with the largest total ``weight`` (by default: rows), totals exact; equal totals by the keys.

    Weights are whole numbers and not negative; NULL weighs nothing.  ``df`` is
    read twice, so it had better be a stored table.
    """
    weight = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    candidates, many = heavy_candidates(df, keys, n, weight, capacity)
    rows = df
    if candidates is not None:
        if many <= SENT_TO_ALL:
            candidates = F.broadcast(candidates)
        rows = df.withColumn(_KEY, _encoded(keys)).join(candidates, _KEY, "left_semi").drop(_KEY)
    totals = rows.groupBy(*keys).agg(F.sum(weight.cast("long")).alias(name))
    return totals.orderBy(F.desc(name), *keys).limit(n)
