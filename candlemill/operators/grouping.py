"""Per-key values, cogroups and user combiners that no single hot key can sink.

The values of a key come back as rows ``(key, value, copies)``, whatever their
number.  Lists are made where they are asked for, with their longest length as
an argument: a key then has its values in order, cut every ``max_len`` values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlemill.workspace import checkpointed


def grouped_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value, copies)``: what a key has and how often; NULL keys and values count."""
    return df.groupBy(key, value).agg(F.count("*").alias("copies"))


def cogrouped_values(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value, left_copies, right_copies)`` for every key and value of either side.

    Both sides name the value alike; a key of one side only has zeros for the other.
    """
    sides = left.select(key, value, F.lit(1).alias("_left")).unionByName(right.select(key, value, F.lit(0).alias("_left")))
    in_left = F.sum("_left")
    return sides.groupBy(key, value).agg(in_left.alias("left_copies"), (F.count("*") - in_left).alias("right_copies"))


def _placed(counted: DataFrame, key: str, order: Sequence[str], max_len: int) -> DataFrame:
    """Pieces ``(key, chunk, order.., copies)`` of the values in order, ``max_len`` values to a chunk.

    The running count of a key is taken in two steps, so that a hot key needs no
    single task: ranges of (key, value) are numbered by partition, summed, and
    the sums before a range are added to the running count inside it.
    """
    ranged = checkpointed(
        counted.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id())
    )
    sums = ranged.groupBy(key, "_part").agg(F.sum("copies").alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(key).alias("_key"), F.col("_part").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    placed = ranged.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of"))).withColumn("_before", before)
    first, last = F.expr(f"_before div {max_len}"), F.expr(f"(_before + copies - 1) div {max_len}")
    pieces = placed.withColumn("chunk", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_before"), F.col("chunk") * max_len)
    end = F.least(F.col("_before") + F.col("copies"), (F.col("chunk") + 1) * max_len)
    return pieces.withColumn("copies", (end - begin).cast("int")).select(key, "chunk", *order, "copies")


def _list_of(value: str, order: Sequence[str]) -> Column:
    """The values of a chunk in order, each as often as it has copies there."""
    entry = F.struct(*order, F.array_repeat(value, F.col("copies")).alias("_values"))
    entries = F.array_sort(F.collect_list(entry))
    return F.flatten(F.transform(entries, lambda e: e["_values"])).alias(value)


def lists_per_key(df: DataFrame, key: str, value: str, max_len: int) -> DataFrame:
    """``(key, chunk, value: list)``: the values of a key in order, NULLs first, ``max_len`` to a list."""
    chunks = _placed(grouped_values(df, key, value), key, [value], max_len)
    return chunks.groupBy(key, "chunk").agg(_list_of(value, [value]))


def combine_by_key(
    df: DataFrame,
    key: str,
    value: str,
    create: Callable[[Any], tuple],
    merge_value: Callable[[tuple, Any], tuple],
    merge_states: Callable[[tuple, tuple], tuple],
    state: T.StructType,
    max_held: int = 50_000,
) -> DataFrame:
    """A user-defined combiner as ``(key, state fields…)``.

    ``create`` starts a state from one value, ``merge_value`` adds a value and
    ``merge_states`` joins two states; a state is a tuple in the order of
    ``state``.  Values are combined where they are read, so a task sends one
    state per key, and the states of a key stream through its merge in sequence:
    a hot key costs as many states as there are tasks.  A task that holds more
    than ``max_held`` keys sends what it has and starts again, so ``merge_states``
    has to give the same whatever is joined first.  All NaN keys are one key, as
    in Spark's own grouping.  A built-in aggregate, if one fits, is faster.
    """
    columns = T.StructType([df.schema[key], *state.fields])
    nan = float("nan")  # one object, so that it is found among the held keys
    arrow = to_arrow_schema(columns)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [
            pa.array([row[i] for row in rows], type=arrow.field(i).type) for i in range(len(arrow.names))
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for name, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = nan if name != name else name
                held[name] = merge_value(held[name], item) if name in held else create(item)
            if len(held) > max_held:
                yield batch_of([(name, *known) for name, known in held.items()])
                held.clear()
        if held:
            yield batch_of([(name, *known) for name, known in held.items()])

    def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            done = []
            for name, *known in zip(*(column.to_pylist() for column in batch.columns)):
                name = nan if name != name else name
                if current is not None and (current[0] is name or current[0] == name):
                    current = (name, merge_states(current[1], tuple(known)))
                    continue
                if current is not None:
                    done.append((current[0], *current[1]))
                current = (name, tuple(known))
            if done:
                yield batch_of(done)
        if current is not None:
            yield batch_of([(current[0], *current[1])])

    states = df.select(key, value).mapInArrow(combine, columns)
    return states.repartition(key).sortWithinPartitions(key).mapInArrow(merge_sorted, columns)
