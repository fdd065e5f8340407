"""Weighted means, disparity, indicators."""

from __future__ import annotations

import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from candlemill.functions import percent_of
from candlemill.operators.ewm import ewm_means, grouped_ewm, mean_name
from candlemill.plans.indicators import (
    SPANS,
    block_states,
    indicator_blocks,
    indicator_columns,
    indicator_states,
    indicators,
    indicators_daily,
    indicators_incremental,
    indicators_rebased,
    indicators_resumed,
    still_valid,
)
from candlemill.registry.base import DAILY_SERIES, daily_series, query, table
from candlemill.workspace import written

STORED_UNTIL = datetime.date(2000, 6, 30)
# The stand-in has gaps where the volume is below this.
GAP = 15


# A mean of two whole numbers often lies exactly between two roundings, where the
# last bit decides; the nudge decides it the same way here and in SQL.
NUDGE = 1e-7


def _round(value: Column, digits: int) -> Column:
    """Half away from zero, as SQL rounds a double; ``F.round`` makes a decimal number of each value.

    The factor is a hair above the power of ten, so an exact half is no half any more.
    """
    return F.rint(value * (10.0**digits * (1 + 2.0**-52))) / 10.0**digits


def _rounded(name: str) -> Column:
    return _round(F.col(name) + NUDGE, 3).alias(name)


def _mean(value: str, span: int) -> str:
    weight = f"pow(1 - 2.0 / ({span} + 1), t.rn - s.rn)"
    return f"sum(s.{value} * {weight}) / sum({weight}) filter (s.{value} is not null)"


def _means_sql(columns: list[str], source: str = DAILY_SERIES, where: str = "true") -> str:
    return f"""
        with r as (select *, row_number() over (partition by code order by day) as rn from ({source}))
        select t.code, t.day, {", ".join(columns)}
        from r t join r s on s.code = t.code and s.rn <= t.rn
        where {where} group by t.code, t.day, t.close, t.rn
    """


def _indicators_sql(where: str = "true", source: str = DAILY_SERIES) -> str:
    columns = []
    for w in SPANS:
        columns += [
            f"round({_mean('close', w)} + {NUDGE}, 3) as eavg_close_{w}",
            f"round({_mean('volume', w)} + {NUDGE}, 3) as eavg_volume_{w}",
            f"round(t.close / ({_mean('close', w)}) * 100, 6) as disparity_{w}",
        ]
    return _means_sql(columns, source, where)


def _rounded_indicators(df):
    return df.select(
        "code",
        "day",
        *[
            _round(F.col(name), 6).alias(name) if name.startswith("disparity") else _rounded(name)
            for name in indicator_columns()
        ],
    )


@query("indicators", _indicators_sql())
def _indicators(spark, d):
    return _rounded_indicators(indicators(daily_series(spark, d)))


@query("indicators_incremental", _indicators_sql(f"t.day > date '{STORED_UNTIL}'"))
def _indicators_incremental(spark, d):
    series = daily_series(spark, d)
    stored = series.where(F.col("day") <= F.lit(STORED_UNTIL))
    return _rounded_indicators(indicators_incremental(series, stored))


def resumed_inputs(spark, d):
    """(arrived rows, stored states), as a daily run finds them."""
    series = daily_series(spark, d)
    until = F.lit(STORED_UNTIL)
    return series.where(F.col("day") > until), written(indicator_states(series.where(F.col("day") <= until)), "states")


@query("indicators_resumed", _indicators_sql(f"t.day > date '{STORED_UNTIL}'"))
def _indicators_resumed(spark, d):
    return _rounded_indicators(indicators_resumed(*resumed_inputs(spark, d)))


# Suppliers whose values come back doubled.
REBASED = "select s_suppkey from supplier where s_acctbal > 5000"


@query(
    "indicators_rebased",
    _indicators_sql(
        source=f"""select code, day, case when code in ({REBASED}) then close * 2 else close end as close, volume
                   from ({DAILY_SERIES})"""
    ),
)
def _indicators_rebased(spark, d):
    stored = daily_series(spark, d)
    changed = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("code"))
    refetched = stored.join(changed, "code", "left_semi").withColumn("close", F.col("close") * 2)
    series = stored.join(changed, "code", "left_anti").unionByName(refetched)
    return _rounded_indicators(indicators_rebased(series, indicators(stored), changed))


# First load: up to a day, without the rows that come late.  Then the rest, and doubled values of some codes.
LATE = "code % 5 = 0 and day between date '2000-02-01' and date '2000-02-29'"


def _daily_indicators(spark, d):
    """(existing indicators, series, the update) of a second run with later, late and rebased rows."""
    old = written(daily_series(spark, d), "series")
    changed = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("code"))
    first = old.where((F.col("day") <= F.lit(STORED_UNTIL)) & ~F.expr(LATE))
    doubled = old.join(changed, "code", "left_semi").withColumn("close", F.col("close") * 2)
    series = written(old.join(changed, "code", "left_anti").unionByName(doubled), "series")
    arrived = series.join(first, ["code", "day"], "left_anti")
    blocks = written(indicator_blocks(first), "blocks")
    return indicators(first), series, indicators_daily(series, arrived, blocks, changed)


REBASED_SERIES = f"""
    select code, day, case when code in ({REBASED}) then close * 2 else close end as close, volume from ({DAILY_SERIES})
"""


@query("indicators_daily", _indicators_sql(source=REBASED_SERIES))
def _indicators_daily(spark, d):
    existing, _, update = _daily_indicators(spark, d)
    return _rounded_indicators(still_valid(existing, update.redone).unionByName(update.added))


@query("indicators_daily_states", f"select code, max(day) as last_day from ({DAILY_SERIES}) group by 1")
def _indicators_daily_states(spark, d):
    """The states after the run are those after the whole history."""
    _, series, update = _daily_indicators(spark, d)
    # Sums in another order differ in the last bits: what both say about the mean of span 5.
    mean = "state.close_5_num / state.close_5_den"
    whole = indicator_states(series).selectExpr("code", "last_day", f"{mean} as _whole")
    both = block_states(update.blocks).selectExpr("code", "last_day", f"{mean} as _here").join(whole, ["code", "last_day"])
    return both.where("abs(_here - _whole) <= 1e-9 * abs(_whole) + 1e-9").select("code", "last_day")


# One day of every third code comes when everything else is stored.
LATE_DAY = "code % 3 = 0 and day = date '2001-03-05'"


def _late_update(spark, d):
    """(existing indicators, the update) when single rows come late."""
    series = written(daily_series(spark, d), "series")
    stored = series.where(f"not ({LATE_DAY})")
    blocks = written(indicator_blocks(stored), "blocks")
    nothing = series.limit(0).select("code")
    return indicators(stored), indicators_daily(series, series.where(LATE_DAY), blocks, nothing)


@query("indicators_late", _indicators_sql())
def _indicators_late(spark, d):
    """Stored indicators with those since the late rows replaced: as if nothing had been late."""
    existing, update = _late_update(spark, d)
    return _rounded_indicators(still_valid(existing, update.redone).unionByName(update.added))


@query(
    "indicators_late_rows",
    f"""with s as ({DAILY_SERIES}) select code, day from s
        join (select code, min(day) as since from s where {LATE_DAY} group by 1) using (code) where day >= since""",
)
def _indicators_late_rows(spark, d):
    """What the late rows make anew: the days of their codes from them on, nothing else."""
    _, update = _late_update(spark, d)
    return update.added.select("code", "day")


def _ewm_query(value: str):
    @query(f"ewm_{value}", _means_sql([f"round({_mean(value, w)} + {NUDGE}, 3) as ewm_{value}_{w}" for w in SPANS]))
    def means(spark, d):
        df = ewm_means(daily_series(spark, d).select("code", "day", value), "code", "day", [value], SPANS)
        return df.select("code", "day", *[_rounded(mean_name(value, w)) for w in SPANS])


_ewm_query("close")
_ewm_query("volume")


@query(
    "ewm_with_gaps",
    _means_sql(
        [f"round({_mean('price', w)} + {NUDGE}, 3) as ewm_price_{w}" for w in SPANS],
        f"select *, case when volume >= {GAP} then close end as price from ({DAILY_SERIES})",
    ),
)
def _ewm_with_gaps(spark, d):
    price = F.when(F.col("volume") >= GAP, F.col("close"))
    series = daily_series(spark, d).withColumn("price", price)
    df = ewm_means(series, "code", "day", ["price"], SPANS)
    return df.select("code", "day", *[_rounded(mean_name("price", w)) for w in SPANS])


@query("udf_grouped_map", _means_sql([f"round({_mean('close', 20)} + {NUDGE}, 3) as ewm_close_20"]))
def _udf_grouped_map(spark, d):
    series = daily_series(spark, d).select("code", "day", "close")
    function, schema = grouped_ewm(series.schema, "code", "day", "close", 20)
    means = series.groupBy("code").applyInPandas(function, schema)
    return means.select("code", "day", _rounded("ewm_close_20"))


@query(
    "disparity",
    f"""select code, day, round(case when volume = 0 then null else cast(close as double) / volume end * 100, 6)
        as disparity from ({DAILY_SERIES})""",
)
def _disparity(spark, d):
    ratio = percent_of(F.col("close"), F.col("volume"))
    return daily_series(spark, d).select("code", "day", F.round(ratio, 6).alias("disparity"))


@query(
    "udf_pandas_scalar",
    f"select code, day, round(cast(close as double) / volume * 100, 6) as disparity from ({DAILY_SERIES})",
)
def _udf_pandas_scalar(spark, d):
    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return a / b * 100

    series = daily_series(spark, d)
    return series.select("code", "day", F.round(ratio("close", "volume"), 6).alias("disparity"))
