"""Indicator build: averages of close and volume and the disparity per span.

Columns per span ``w``: ``eavg_close_w``, ``eavg_volume_w`` and ``disparity_w``
(close over its average, times 100).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.functions import compact_date, parse_compact_date, percent_of
from candlemill.operators.ewm import (
    BLOCK,
    LAST_DAY,
    block_of,
    block_schema,
    ewm_blocks,
    ewm_means,
    ewm_pass,
    ewm_states,
    first_day_of,
    joined_blocks,
    mean_name,
    passed_blocks,
    state_schema,
    states_of,
)
from candlemill.operators.keyed import drop_listed, keep_listed, match_keyed, one_row_per_key
from candlemill.workspace import written

# The spans of the stored indicators and the stored column names.
SPANS = (5, 20, 60, 112, 224, 448)
STORED_NAMES = {"close": "EAVG_Close", "volume": "EAVG_Volume", "disparity": "Disparty"}

CODE, DAY, CLOSE, VOLUME = "code", "day", "close", "volume"
MEASURES = (CLOSE, VOLUME)


def price_series(stored: DataFrame) -> DataFrame:
    """Stored prices (text dates, float measures) as ``(code, day, close, volume)``.

    One row per code and day; a code keeps its leading zeros.
    """
    typed = stored.select(
        F.col("stockcode").cast("string").alias(CODE),
        parse_compact_date(F.col("stockdate")).alias(DAY),
        F.col("stockclose").cast("long").alias(CLOSE),
        F.col("stockvolume").cast("long").alias(VOLUME),
    )
    return one_row_per_key(typed, [CODE, DAY])


def indicator_columns(spans: Sequence[int] = SPANS) -> list[str]:
    return [name for w in spans for name in (f"eavg_close_{w}", f"eavg_volume_{w}", f"disparity_{w}")]


def _finished(means: DataFrame, spans: Sequence[int]) -> DataFrame:
    columns = []
    for w in spans:
        close = F.col(mean_name(CLOSE, w))
        columns += [
            close.alias(f"eavg_close_{w}"),
            F.col(mean_name(VOLUME, w)).alias(f"eavg_volume_{w}"),
            percent_of(F.col(CLOSE), close).alias(f"disparity_{w}"),
        ]
    return means.select(DAY, CODE, *columns)


def indicators(series: DataFrame, spans: Sequence[int] = SPANS, carried: DataFrame | None = None) -> DataFrame:
    """All indicator columns for a ``(code, day, close, volume)`` series."""
    return _finished(ewm_means(series, CODE, DAY, MEASURES, spans, carried), spans)


def indicators_incremental(series: DataFrame, existing: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """Indicators of the rows whose (day, code) is not stored yet, from full history."""
    stored = existing.select(DAY, CODE).distinct()
    return indicators(series, spans).join(stored, [DAY, CODE], "left_anti")


def indicator_states(series: DataFrame, spans: Sequence[int] = SPANS, carried: DataFrame | None = None) -> DataFrame:
    """What ``indicators_resumed`` needs to go on without the history."""
    return ewm_states(series, CODE, DAY, MEASURES, spans, carried)


def no_states(series: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """An empty state table, for a first load."""
    return series.sparkSession.createDataFrame([], state_schema(series.schema[CODE], MEASURES, spans))


def indicator_blocks(series: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """The block summaries of whole series, which ``indicators_daily`` goes on from."""
    return ewm_blocks(series, CODE, DAY, MEASURES, spans)


def no_blocks(series: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """An empty block table, for a first load."""
    return series.sparkSession.createDataFrame([], block_schema(series.schema[CODE], MEASURES, spans))


def block_states(blocks: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """``indicator_states`` of the rows behind stored blocks, for ``indicators_resumed``."""
    return states_of(blocks, CODE, MEASURES, spans)


def late_codes(arrived: DataFrame, states: DataFrame) -> DataFrame:
    """Codes with an arrived row that is not after their stored state.

    Their states no longer describe a prefix of the series; they need
    ``indicators`` over their whole history.
    """
    first = arrived.groupBy(CODE).agg(F.min(DAY).alias("_first"))
    return first.join(states.select(CODE, "last_day"), CODE).where("_first <= last_day").select(CODE)


def indicators_resumed(arrived: DataFrame, states: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """Indicators of newly arrived rows, from stored states instead of history.

    Equal to ``indicators`` over history plus arrivals for every code outside
    ``late_codes``; those codes are left out here.
    """
    return indicators(drop_listed(arrived, CODE, late_codes(arrived, states)), spans, states)


def indicators_rebased(
    series: DataFrame, existing: DataFrame, rebased: DataFrame, spans: Sequence[int] = SPANS
) -> DataFrame:
    """All stored indicators after some codes got a new history.

    Only the rebased codes are computed again; an anti join on (day, code) alone
    would keep their old values for ever.
    """
    fresh = indicators(keep_listed(series, CODE, rebased), spans)
    return drop_listed(existing, CODE, rebased).select(fresh.columns).unionByName(fresh)


@dataclass(frozen=True)
class IndicatorUpdate:
    """What an indicator run has to store."""

    redone: DataFrame  # (code, since): stored indicators from that day on are void, all of them where it is NULL
    added: DataFrame  # indicator rows to append after that
    blocks: DataFrame  # the block summaries to go on from next time


def still_valid(existing: DataFrame, redone: DataFrame) -> DataFrame:
    """The stored indicators that an update leaves as they are."""
    since = redone.select(CODE, F.col("since").alias("_since"))
    void = F.col("_since").isNull() | (F.col(DAY) >= F.col("_since"))
    return match_keyed(existing, since, [CODE], "left_anti", void)


def _redone(arrived: DataFrame, blocks: DataFrame, rebased: DataFrame, spans: Sequence[int]) -> DataFrame:
    """``(code, since, block)`` of the codes whose rows must be read again, from a block on or (NULL) all."""
    stored = blocks.groupBy(CODE).agg(F.max(LAST_DAY).alias("_stored"))
    first = arrived.groupBy(CODE).agg(F.min(DAY).alias("since"))
    late = first.join(stored, CODE).where(F.col("since") <= F.col("_stored")).select(CODE, "since")
    late = drop_listed(late, CODE, rebased).withColumn(BLOCK, block_of("since", spans))
    anew = rebased.select(CODE).distinct()
    return late.unionByName(anew, allowMissingColumns=True)


def indicators_daily(
    series: DataFrame,
    arrived: DataFrame,
    blocks: DataFrame,
    rebased: DataFrame,
    spans: Sequence[int] = SPANS,
) -> IndicatorUpdate:
    """One run: codes with later rows go on from their blocks, late ones from the block of
    their first late row, rebased ones from the beginning.

    ``series`` is the whole stored history with the ``arrived`` rows in it; of late
    codes it is read from the earliest such block on, of rebased codes
    whole.  ``rebased`` are codes whose history was fetched again.  Means and blocks
    come from one pass, which is written once.
    """
    redone = written(_redone(arrived, blocks, rebased, spans), "redone")
    late, anew = redone.where(F.col("since").isNotNull()), redone.where(F.col("since").isNull())
    begins = late.select(CODE, F.col("since").alias("_since"), first_day_of(BLOCK, spans).alias("_begin"))
    # One date, so that the scan of the history skips what is before it.
    earliest = begins.agg(F.min("_begin")).first()[0]
    recent = series.where(F.col(DAY) >= F.lit(earliest).cast("date"))
    again = match_keyed(recent, begins, [CODE], "inner", F.col(DAY) >= F.col("_begin")).drop("_begin")
    # Blocks that stand in front of the rows read here; all of them for codes that just go on.
    touched = redone.select(CODE, F.col("since").isNull().alias("_all"), F.col(BLOCK).alias("_block"))
    before = match_keyed(blocks, touched, [CODE], "left_anti", F.col("_all") | (F.col(BLOCK) >= F.col("_block")))
    rows = (
        drop_listed(arrived, CODE, redone)
        .unionByName(keep_listed(series, CODE, anew))
        .select(series.columns)
        .unionByName(again, allowMissingColumns=True)
    )
    passed = written(ewm_pass(rows, CODE, DAY, MEASURES, spans, states_of(before, CODE, MEASURES, spans)), "indicators")
    # Rows of a block in front of its first late row were read for their sums only.
    fresh = passed.where(F.col("_since").isNull() | (F.col(DAY) >= F.col("_since")))
    return IndicatorUpdate(
        redone=redone.select(CODE, "since"),
        added=_finished(fresh, spans),
        blocks=joined_blocks(before, passed_blocks(passed, CODE, DAY), CODE, MEASURES, spans),
    )


def stored_layout(df: DataFrame, spans: Sequence[int] = SPANS) -> DataFrame:
    """Indicators as stored: text dates and 32-bit floats, 20 columns."""
    columns = [compact_date(F.col(DAY)).alias("stockdate"), F.col(CODE).cast("string").alias("stockcode")]
    for w in spans:
        columns += [
            F.col(f"eavg_close_{w}").cast(T.FloatType()).alias(f"{STORED_NAMES['close']}_{w}"),
            F.col(f"eavg_volume_{w}").cast(T.FloatType()).alias(f"{STORED_NAMES['volume']}_{w}"),
            F.col(f"disparity_{w}").cast(T.FloatType()).alias(f"{STORED_NAMES['disparity']}_{w}"),
        ]
    return df.select(*columns)
