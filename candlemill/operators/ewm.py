"""Exponentially weighted means per series, by blocks of calendar days.

For a span ``w`` the weight of a row ``j`` rows back is ``r**j`` with
``r = 1 - 2 / (w + 1)``; the mean at a row is the weighted sum of all values so
far over the sum of their weights.  Positions count every row of the series, a
NULL value adds nothing, and the mean is NULL before the first value.

A series is cut into blocks of ``block_days`` days.  One row per (key, date) is
required, so a block never holds more rows than days and no task ever holds a
whole long series:

1. inside a block, numerator and denominator are running sums of
   ``value * r**-position`` scaled back by ``r**position``;
2. each block is summarised by its row count and end state, one small row;
3. the few summaries of a series are folded from left to right, which gives
   each block the state it starts from (decayed by ``r**rows`` per block);
4. that state joins back on (key, block), the partitioning the running sums
   already have, so the rows themselves are shuffled once.

``block_days`` is lowered where ``r**-block_days`` would leave the double range.

The summaries can be stored: folded in order they give the state at any block's
end, and two of them in sequence make one.  A row that comes late thus asks for
its own block and the rows behind it, never for the blocks in front.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_DAYS = 1024
# r**-n may grow to 10**LARGEST_POWER, which leaves room for values up to 10**80.
LARGEST_POWER = 200

_FIRST_BLOCK = -(2**31)


def mean_name(value: str, span: int) -> str:
    return f"ewm_{value}_{span}"


def _retention(span: int) -> float:
    if span <= 1:
        raise ValueError("a span must be above 1")
    return 1 - 2.0 / (span + 1)


def _block_length(spans: Sequence[int], wanted: int) -> int:
    steepest = -math.log10(_retention(min(spans)))
    return max(1, min(wanted, int(LARGEST_POWER / steepest)))


class _Layout:
    """Names and SQL of the running sums for some values and spans."""

    def __init__(self, values: Sequence[str], spans: Sequence[int]):
        self.values, self.spans = list(values), list(spans)
        self.retention = {w: _retention(w) for w in self.spans}
        # (name, span, term) of every numerator and denominator.
        self.sums = []
        for value in self.values:
            for w in self.spans:
                grow = f"_grow_{w}"
                self.sums += [
                    (f"{value}_{w}_num", w, f"if(`{value}` is null, 0D, `{value}` * {grow})"),
                    (f"{value}_{w}_den", w, f"if(`{value}` is null, 0D, {grow})"),
                ]

    def state_type(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.DoubleType()) for name, _, _ in self.sums])

    def power(self, span: int, exponent: str) -> str:
        return f"pow({self.retention[span]!r}D, {exponent})"

    def fold(self, blocks: str) -> str:
        """The state after some blocks in order, from an empty one."""
        empty = ", ".join(f"0D as `{name}`" for name, _, _ in self.sums)
        merged = ", ".join(f"s.`{name}` * b._decay_{w} + b.`{name}` as `{name}`" for name, w, _ in self.sums)
        return f"aggregate({blocks}, struct({empty}), (s, b) -> struct({merged}))"


def _positions(series: DataFrame, key: str, day: str, layout: _Layout, block_days: int) -> DataFrame:
    within = Window.partitionBy(key, "_block").orderBy(day)
    return (
        series.where(F.col(key).isNotNull() & F.col(day).isNotNull())
        .withColumn("_block", F.expr(f"coalesce(cast(unix_date(`{day}`) div {block_days} as int), 0)"))
        .withColumn("_pos", F.row_number().over(within))
        .selectExpr("*", *[f"{layout.power(w, '-_pos')} as _grow_{w}" for w in layout.spans])
    )


def _block_ends(positioned: DataFrame, key: str, day: str, layout: _Layout) -> DataFrame:
    """One row per (key, block): last day, decay over the block, state at its end."""
    totals = positioned.groupBy(key, "_block").agg(
        F.max(day).alias("_last"),
        F.count("*").alias("_rows"),
        *[F.expr(f"sum({term}) as `{name}`") for name, _, term in layout.sums],
    )
    decay = [f"{layout.power(w, '_rows')} as _decay_{w}" for w in layout.spans]
    state = [f"`{name}` * {layout.power(w, '_rows')} as `{name}`" for name, w, _ in layout.sums]
    return totals.selectExpr(f"`{key}`", "_block", "_last", *decay, *state)


def _as_first_block(states: DataFrame, key: str, layout: _Layout) -> DataFrame:
    """Stored states, shaped as a block that precedes every other one."""
    return states.selectExpr(
        f"`{key}`",
        f"int({_FIRST_BLOCK}) as _block",
        "last_day as _last",
        *[f"0D as _decay_{w}" for w in layout.spans],
        *[f"state.`{name}` as `{name}`" for name, _, _ in layout.sums],
    )


def _summaries(
    positioned: DataFrame, key: str, day: str, layout: _Layout, carried: DataFrame | None
) -> DataFrame:
    """All block summaries of a series in order; at most one per block of days."""
    ends = _block_ends(positioned, key, day, layout)
    if carried is not None:
        ends = ends.unionByName(_as_first_block(carried, key, layout))
    fields = [name for name in ends.columns if name != key]
    return ends.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_blocks"))


def _running(
    series: DataFrame, key: str, day: str, layout: _Layout, block_days: int, carried: DataFrame | None, more: Sequence[str] = ()
) -> DataFrame:
    """``series`` with ``_block``, its running sums and ``_start``, the state its block starts from."""
    positioned = _positions(series, key, day, layout, block_days)
    before = layout.fold("filter(_blocks, b -> b._block < here._block)")
    starts = _summaries(positioned, key, day, layout, carried).selectExpr(
        f"`{key}`", f"inline(transform(_blocks, here -> struct(here._block as _block, {before} as _start)))"
    )
    so_far = f"over (partition by `{key}`, _block order by `{day}` rows unbounded preceding)"
    kept = [f"`{name}`" for name in series.columns]
    running = positioned.selectExpr(
        *kept, "_block", *more, *[f"sum({term}) {so_far} as `{name}`" for name, _, term in layout.sums]
    )
    return running.join(starts, [key, "_block"])


def _means_of(layout: _Layout) -> list[str]:
    means = []
    for value in layout.values:
        for w in layout.spans:
            num, den = (f"(`{value}_{w}_{part}` + _start.`{value}_{w}_{part}`)" for part in ("num", "den"))
            means.append(f"try_divide({num}, {den}) as `{mean_name(value, w)}`")
    return means


def ewm_means(
    series: DataFrame,
    key: str,
    day: str,
    values: Sequence[str],
    spans: Sequence[int],
    carried: DataFrame | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``series`` with one mean per value and span, named by ``mean_name``.

    ``series`` holds one row per (key, day); rows without a key or a day belong
    to no series and are left out.  ``carried`` is the output of ``ewm_states``
    for the rows before these ones.
    """
    layout = _Layout(values, spans)
    running = _running(series, key, day, layout, _block_length(spans, block_days), carried)
    return running.selectExpr(*[f"`{name}`" for name in series.columns], *_means_of(layout))


BLOCK, LAST_DAY, END = "block", "last_day", "block_end"


def _end_fields(layout: _Layout) -> list[str]:
    return [f"decay_{w}" for w in layout.spans] + [name for name, _, _ in layout.sums]


def block_of(day: str, spans: Sequence[int], block_days: int = BLOCK_DAYS) -> Column:
    """The number of the block that a day is in."""
    return F.expr(f"cast(unix_date(`{day}`) div {_block_length(spans, block_days)} as int)")


def first_day_of(block: str, spans: Sequence[int], block_days: int = BLOCK_DAYS) -> Column:
    """A day that none of the block's days is before (blocks of negative numbers count towards zero)."""
    length = _block_length(spans, block_days)
    return F.expr(f"date_from_unix_date(`{block}` * {length} - if(`{block}` <= 0, {length - 1}, 0))")


def ewm_pass(
    series: DataFrame,
    key: str,
    day: str,
    values: Sequence[str],
    spans: Sequence[int],
    carried: DataFrame | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``ewm_means`` and the block summaries in one pass: with ``block``, and ``block_end`` on the last row of each block.

    ``block_end`` has the decay over the rows of the block that are in ``series``,
    and the sums at its end without what is ``carried``; it is NULL on other rows.
    """
    layout = _Layout(values, spans)
    is_last = f"lead(1) over (partition by `{key}`, _block order by `{day}`) is null as _is_last"
    running = _running(series, key, day, layout, _block_length(spans, block_days), carried, ["_pos", is_last])
    ends = [f"{layout.power(w, '_pos')} as decay_{w}" for w in layout.spans]
    ends += [f"`{name}` * {layout.power(w, '_pos')} as `{name}`" for name, w, _ in layout.sums]
    return running.selectExpr(
        *[f"`{name}`" for name in series.columns], *_means_of(layout), f"_block as {BLOCK}",
        f"if(_is_last, struct({', '.join(ends)}), null) as {END}",
    )


def passed_blocks(passed: DataFrame, key: str, day: str) -> DataFrame:
    """The block summaries of ``ewm_pass``: ``(key, block, last_day, block_end)``."""
    return passed.where(F.col(END).isNotNull()).select(key, BLOCK, F.col(day).alias(LAST_DAY), END)


def ewm_blocks(
    series: DataFrame, key: str, day: str, values: Sequence[str], spans: Sequence[int], block_days: int = BLOCK_DAYS
) -> DataFrame:
    """The block summaries of whole series, to be stored: ``(key, block, last_day, block_end)``."""
    layout = _Layout(values, spans)
    positioned = _positions(series, key, day, layout, _block_length(spans, block_days))
    fields = [f"_decay_{w} as decay_{w}" for w in layout.spans] + [f"`{name}`" for name, _, _ in layout.sums]
    ends = _block_ends(positioned, key, day, layout)
    return ends.selectExpr(f"`{key}`", f"_block as {BLOCK}", f"_last as {LAST_DAY}", f"struct({', '.join(fields)}) as {END}")


def block_schema(key: T.StructField, values: Sequence[str], spans: Sequence[int]) -> T.StructType:
    """Schema of ``ewm_blocks``, for stored blocks that do not exist yet."""
    end = T.StructType([T.StructField(name, T.DoubleType()) for name in _end_fields(_Layout(values, spans))])
    return T.StructType([key, T.StructField(BLOCK, T.IntegerType()), T.StructField(LAST_DAY, T.DateType()), T.StructField(END, end)])


def _folded(layout: _Layout, ends: str) -> str:
    """Summaries in sequence as one."""
    start = ", ".join([f"1D as decay_{w}" for w in layout.spans] + [f"0D as `{name}`" for name, _, _ in layout.sums])
    step = [f"s.decay_{w} * b.{END}.decay_{w} as decay_{w}" for w in layout.spans]
    step += [f"s.`{name}` * b.{END}.decay_{w} + b.{END}.`{name}` as `{name}`" for name, w, _ in layout.sums]
    return f"aggregate({ends}, struct({start}), (s, b) -> struct({', '.join(step)}))"


def states_of(blocks: DataFrame, key: str, values: Sequence[str], spans: Sequence[int]) -> DataFrame:
    """What ``ewm_states`` gives for the rows behind ``blocks``; a series has a block per ``block_days`` days."""
    layout = _Layout(values, spans)
    in_order = F.sort_array(F.collect_list(F.struct(BLOCK, LAST_DAY, END))).alias("_blocks")
    names = ", ".join(f"_state.`{name}` as `{name}`" for name, _, _ in layout.sums)
    folded = blocks.groupBy(key).agg(in_order).selectExpr(
        f"`{key}`", f"element_at(_blocks, -1).{LAST_DAY} as last_day", f"{_folded(layout, '_blocks')} as _state"
    )
    return folded.selectExpr(f"`{key}`", "last_day", f"struct({names}) as state")


def joined_blocks(
    earlier: DataFrame, later: DataFrame, key: str, values: Sequence[str], spans: Sequence[int]
) -> DataFrame:
    """Stored blocks with those of later rows behind them; a block that both have becomes one."""
    layout = _Layout(values, spans)
    both = earlier.withColumn("_turn", F.lit(0)).unionByName(later.withColumn("_turn", F.lit(1)))
    parts = both.groupBy(key, BLOCK).agg(F.sort_array(F.collect_list(F.struct("_turn", LAST_DAY, END))).alias("_parts"))
    return parts.selectExpr(
        f"`{key}`", BLOCK, f"element_at(_parts, -1).{LAST_DAY} as {LAST_DAY}", f"{_folded(layout, '_parts')} as {END}"
    )


def ewm_states(
    series: DataFrame,
    key: str,
    day: str,
    values: Sequence[str],
    spans: Sequence[int],
    carried: DataFrame | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """The state after the last row of each series: ``(key, last_day, state)``."""
    layout = _Layout(values, spans)
    positioned = _positions(series, key, day, layout, _block_length(spans, block_days))
    return _summaries(positioned, key, day, layout, carried).selectExpr(
        f"`{key}`", "element_at(_blocks, -1)._last as last_day", f"{layout.fold('_blocks')} as state"
    )


def state_schema(key: T.StructField, values: Sequence[str], spans: Sequence[int]) -> T.StructType:
    """Schema of ``ewm_states``, for stored states that do not exist yet."""
    return T.StructType(
        [key, T.StructField("last_day", T.DateType()), T.StructField("state", _Layout(values, spans).state_type())]
    )


def grouped_ewm(
    schema: T.StructType, key: str, day: str, value: str, span: int
) -> tuple[Callable[[pd.DataFrame], pd.DataFrame], T.StructType]:
    """Function and output schema for ``groupBy(key).applyInPandas``.

    The form for a caller's own grouped function: one Python call per series.
    The group is one daily series, so it is no longer than the days it spans;
    ``ewm_means`` has no such limit and needs no Python.
    """
    name = mean_name(value, span)
    out = T.StructType([schema[key], schema[day], schema[value], T.StructField(name, T.DoubleType())])

    def one_series(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(day)
        return rows[[key, day, value]].assign(**{name: rows[value].astype("float64").ewm(span=span).mean()})

    return one_series, out
