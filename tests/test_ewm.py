"""Weighted means against pandas, in blocks, resumed, and with gaps."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlemill.operators import ewm
from candlemill.operators.ewm import ewm_means, ewm_states, grouped_ewm, mean_name
from candlemill.plans import indicators as ind
from candlemill.workspace import written

START = datetime.date(2001, 3, 1)


def random_series(seed, codes=6, longest=900, missing=0.3):
    rng = np.random.default_rng(seed)
    parts = []
    for number in range(codes):
        n = 1 if number == 0 else int(rng.integers(2, longest))
        days = np.sort(rng.choice(longest * 2, size=n, replace=False))
        close = rng.normal(5_000, 2_000, n).round(2)
        close[rng.random(n) < missing] = np.nan
        if number == 1:
            close[:] = np.nan
        parts.append(
            pd.DataFrame(
                {
                    "code": f"{number:06d}",
                    "day": [START + datetime.timedelta(days=int(d)) for d in days],
                    "close": close,
                    "volume": rng.integers(0, 2**30, n),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def frame(spark, pdf):
    rows = [
        (c, d, None if pd.isna(x) else float(x), int(v))
        for c, d, x, v in pdf[["code", "day", "close", "volume"]].itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "code string, day date, close double, volume bigint")


def expected(pdf, value, span):
    pdf = pdf.sort_values(["code", "day"])
    return pdf.groupby("code")[value].transform(lambda x: x.astype("float64").ewm(span=span).mean()).to_numpy()


def check(found, pdf, spans, values=("close", "volume")):
    pdf = pdf.sort_values(["code", "day"])
    found = found.toPandas().sort_values(["code", "day"])
    assert list(found["code"]) == list(pdf["code"])
    for value in values:
        for span in spans:
            np.testing.assert_allclose(
                found[mean_name(value, span)].astype("float64").to_numpy(),
                expected(pdf, value, span),
                rtol=1e-11,
                equal_nan=True,
            )


@pytest.mark.parametrize("block_days", [7, 64, 1024])
def test_blocks_agree_with_pandas(spark, block_days):
    pdf = random_series(block_days)
    spans = [2, 5, 20, 448]
    check(
        ewm_means(frame(spark, pdf), "code", "day", ["close", "volume"], spans, block_days=block_days), pdf, spans
    )


def test_resumed_from_states_equals_the_whole(spark):
    pdf = random_series(11)
    spans = [5, 60]
    cut = START + datetime.timedelta(days=500)
    early, late = pdf[pdf["day"] <= cut], pdf[pdf["day"] > cut]
    values = ["close", "volume"]
    states = ewm_states(frame(spark, early), "code", "day", values, spans, block_days=90)
    resumed = ewm_means(frame(spark, late), "code", "day", values, spans, states, block_days=90)
    whole = ewm_means(frame(spark, pdf), "code", "day", values, spans).where(f"day > date '{cut}'")
    keys = ["code", "day"]
    names = [mean_name(v, w) for v in values for w in spans]
    a = resumed.toPandas().sort_values(keys).reset_index(drop=True)
    b = whole.toPandas().sort_values(keys).reset_index(drop=True)
    assert len(a) == len(late)
    np.testing.assert_allclose(a[names].astype(float), b[names].astype(float), rtol=1e-11, equal_nan=True)


def test_states_chain(spark):
    pdf = random_series(12)
    cut = START + datetime.timedelta(days=400)
    values, spans = ["close", "volume"], [5, 60]
    first = ewm_states(frame(spark, pdf[pdf["day"] <= cut]), "code", "day", values, spans)
    chained = ewm_states(frame(spark, pdf[pdf["day"] > cut]), "code", "day", values, spans, first).collect()
    whole = {row["code"]: row for row in ewm_states(frame(spark, pdf), "code", "day", values, spans).collect()}
    assert {row["code"] for row in chained} == set(whole)
    for row in chained:
        assert row["last_day"] == whole[row["code"]]["last_day"]
        np.testing.assert_allclose(list(row["state"]), list(whole[row["code"]]["state"]), rtol=1e-11)


def test_leading_nulls_and_gaps(spark):
    days = [START + datetime.timedelta(days=i) for i in range(5)]
    rows = [("a", d, x) for d, x in zip(days, [None, 1.0, None, None, 3.0])]
    df = spark.createDataFrame(rows, "code string, day date, x double")
    found = [row["ewm_x_5"] for row in ewm_means(df, "code", "day", ["x"], [5]).orderBy("day").collect()]
    wanted = pd.Series([np.nan, 1, np.nan, np.nan, 3]).ewm(span=5).mean()
    assert found[0] is None
    assert found[1] == found[2] == found[3] == 1.0
    assert found[4] == pytest.approx(wanted[4])


def test_rows_without_key_or_day_belong_to_no_series(spark):
    df = spark.createDataFrame([(None, START, 1.0), ("a", None, 2.0), ("a", START, 3.0)], "code string, day date, x double")
    assert [tuple(row) for row in ewm_means(df, "code", "day", ["x"], [5]).collect()] == [("a", START, 3.0, 3.0)]


def test_empty_series(spark):
    df = spark.createDataFrame([], "code string, day date, x double")
    assert ewm_means(df, "code", "day", ["x"], [5]).count() == 0


def test_long_steep_series_does_not_overflow(spark):
    n = 6_000
    pdf = pd.DataFrame(
        {
            "code": "a",
            "day": [START + datetime.timedelta(days=i) for i in range(n)],
            "close": np.linspace(1e5, 2e5, n),
            "volume": np.arange(n),
        }
    )
    check(ewm_means(frame(spark, pdf), "code", "day", ["close", "volume"], [3, 5]), pdf, [3, 5])


def test_span_must_be_above_one(spark):
    with pytest.raises(ValueError):
        ewm_means(spark.createDataFrame([], "code string, day date, x double"), "code", "day", ["x"], [1])


def test_grouped_function_agrees(spark):
    pdf = random_series(5, codes=3)
    series = frame(spark, pdf).select("code", "day", "close")
    function, schema = grouped_ewm(series.schema, "code", "day", "close", 20)
    assert schema.fieldNames() == ["code", "day", "close", "ewm_close_20"]
    check(series.groupBy("code").applyInPandas(function, schema), pdf, [20], ["close"])


# ---- the indicator job


def test_indicator_columns_and_zero_close(spark):
    rows = [("000020", START, 0, 5), ("000020", START + datetime.timedelta(days=1), 10, 5)]
    series = spark.createDataFrame(rows, "code string, day date, close bigint, volume bigint")
    df = ind.indicators(series)
    assert df.columns == ["day", "code", *ind.indicator_columns()]
    first, second = df.orderBy("day").collect()
    assert first["eavg_close_5"] == 0 and first["disparity_5"] is None
    assert second["disparity_5"] == pytest.approx(10 / (10 / (1 + 2 / 3)) * 100)


def test_incremental_equals_full(spark):
    series = frame(spark, random_series(3, missing=0)).withColumn("close", ind.F.col("close").cast("long"))
    full = ind.indicators(series, [5, 20]).collect()
    half = ind.indicators(series, [5, 20]).where("day < date '2002-01-01'")
    fresh = ind.indicators_incremental(series, half, [5, 20])
    assert sorted(map(repr, half.collect() + fresh.collect())) == sorted(map(repr, full))
    assert ind.indicators_incremental(series, ind.indicators(series, [5, 20]), [5, 20]).count() == 0


def test_late_rows_are_reported_and_left_out(spark):
    day = lambda i: START + datetime.timedelta(days=i)
    shape = "code string, day date, close bigint, volume bigint"
    states = ind.indicator_states(spark.createDataFrame([("a", day(5), 1, 1), ("b", day(5), 1, 1)], shape), [5])
    arrived = spark.createDataFrame([("a", day(6), 2, 2), ("b", day(4), 2, 2), ("c", day(1), 7, 7)], shape)
    assert [row["code"] for row in ind.late_codes(arrived, states).collect()] == ["b"]
    assert sorted(row["code"] for row in ind.indicators_resumed(arrived, states, [5]).collect()) == ["a", "c"]


def test_first_load_has_no_states(spark):
    series = frame(spark, random_series(4, missing=0)).withColumn("close", ind.F.col("close").cast("long"))
    resumed = ind.indicators_resumed(series, ind.no_states(series, [5]), [5])
    assert resumed.count() == series.count()


def test_stored_prices_are_typed_and_unique(spark):
    stored = spark.createDataFrame(
        [("20240102", "000020", 10.0, 2.0**25), ("20240102", "000020", 10.0, 2.0**25), ("bad", "000020", 1.0, 1.0)],
        "stockdate string, stockcode string, stockclose double, stockvolume double",
    )
    rows = sorted(map(tuple, ind.price_series(stored).collect()), key=repr)
    assert rows == [("000020", None, 1, 1), ("000020", datetime.date(2024, 1, 2), 10, 2**25)]


def test_stored_layout(spark):
    rows = [("000020", START, 10, 5)]
    series = spark.createDataFrame(rows, "code string, day date, close bigint, volume bigint")
    stored = ind.stored_layout(ind.indicators(series))
    assert stored.columns[:5] == ["stockdate", "stockcode", "EAVG_Close_5", "EAVG_Volume_5", "Disparty_5"]
    assert len(stored.columns) == 20
    assert {f.dataType.simpleString() for f in stored.schema.fields[2:]} == {"float"}
    assert stored.first()["stockdate"] == "20010301"


def test_rebased_codes_are_computed_again(spark):
    series = frame(spark, random_series(9, missing=0)).withColumn("close", ind.F.col("close").cast("long"))
    existing = ind.indicators(series, [5])
    rebased = series.where("code = '000002'").select("code")
    changed = series.withColumn("close", ind.F.expr("if(code = '000002', close * 3, close)"))
    found = ind.indicators_rebased(changed, existing, rebased, [5])
    wanted = ind.indicators(changed, [5])
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


# ---- stored blocks


def _whole(spark, seed, codes=5):
    series = frame(spark, random_series(seed, codes=codes, missing=0)).select("code", "day", "close", "volume")
    return series.withColumn("close", ind.F.col("close").cast("long")).withColumn("volume", ind.F.col("volume").cast("long"))


def _near(a, b):
    """Indicator rows that agree up to the last digits."""
    a, b = (sorted((row["code"], row["day"], *[-1.0 if x is None else x for x in row[2:]]) for row in df.collect()) for df in (a, b))
    assert [row[:2] for row in a] == [row[:2] for row in b]
    for one, other in zip(a, b):
        assert list(one[2:]) == pytest.approx(list(other[2:]), rel=1e-9)


def test_one_pass_gives_means_and_blocks(spark):
    series = _whole(spark, 21)
    layout = ("code", "day", ["close", "volume"], [5, 20])
    passed = ewm.ewm_pass(series, *layout, block_days=100)
    means = ewm_means(series, *layout, block_days=100)
    assert sorted(map(repr, passed.select(means.columns).collect())) == sorted(map(repr, means.collect()))
    blocks = ewm.passed_blocks(passed, "code", "day")
    wanted = ewm.ewm_blocks(series, *layout, block_days=100)
    shape = ewm.block_schema(series.schema["code"], ["close", "volume"], [5, 20])
    assert wanted.schema.simpleString() == blocks.schema.simpleString() == shape.simpleString()
    for one, other in zip(*(sorted(df.collect(), key=lambda r: r[:2]) for df in (blocks, wanted))):
        assert one[:3] == other[:3] and list(one["block_end"]) == pytest.approx(list(other["block_end"]), rel=1e-9)
    states = {row["code"]: row for row in ewm_states(series, *layout).collect()}
    for row in ewm.states_of(wanted, "code", ["close", "volume"], [5, 20]).collect():
        assert row["last_day"] == states[row["code"]]["last_day"]
        assert list(row["state"]) == pytest.approx(list(states[row["code"]]["state"]), rel=1e-9)


@pytest.mark.parametrize("seed", [31])
def test_runs_with_late_later_and_rebased_rows(spark, monkeypatch, seed):
    """Rows come in four runs, at random; after each the indicators are those of all rows so far."""
    monkeypatch.setattr(ewm, "_block_length", lambda spans, wanted: 64)
    stretch = ind.F.expr(f"pmod(xxhash64(code, datediff(day, date '2000-01-01') div 9, {seed}), 4)")
    every = written(_whole(spark, seed, codes=4).withColumn("run", stretch), "every")
    blocks, stored = ind.no_blocks(every.drop("run"), [5, 20]), None
    for run in range(4):
        rebased = every.where("code = '000002'").select("code").distinct() if run == 2 else every.limit(0).select("code")
        if run == 2:
            every = written(every.withColumn("close", ind.F.expr("if(code = '000002', close * 3, close)")), "every")
        series = written(every.where(f"run <= {run}").drop("run"), "series")
        update = ind.indicators_daily(series, every.where(f"run = {run}").drop("run"), blocks, rebased, [5, 20])
        stored = update.added if stored is None else ind.still_valid(stored, update.redone).unionByName(update.added)
        stored, blocks = written(stored, "stored"), written(update.blocks, "blocks")
        _near(stored, ind.indicators(series, [5, 20]))
        assert blocks.count() == blocks.select("code", "block").distinct().count()


def test_a_late_row_reads_no_earlier_block(spark, tmp_path):
    """The history before the late row's block is neither in the plan's range nor needed."""
    days = [datetime.date(1990, 1, 1) + datetime.timedelta(n) for n in range(0, 9000, 3)]
    path = str(tmp_path / "series")
    rows = [("a", day, n % 50 + 1, 5) for n, day in enumerate(days)] + [("b", day, n % 7 + 1, 5) for n, day in enumerate(days)]
    series = spark.createDataFrame(rows, "code string, day date, close bigint, volume bigint")
    series.repartitionByRange(4, "day").write.parquet(path)
    late = datetime.date(2010, 1, 4)
    stored = spark.read.parquet(path).where(f"not (code = 'a' and day = date '{days[2440]}')")
    arrived = spark.read.parquet(path).where(f"code = 'a' and day = date '{days[2440]}'")
    assert days[2440] >= late and arrived.count() == 1
    blocks = written(ind.indicator_blocks(stored, [5]), "blocks")
    begin = ewm.first_day_of("block", [5])
    first_read = arrived.select(ewm.block_of("day", [5]).alias("block")).select(begin.alias("d")).first()["d"]
    # What lies in front of the block is gone: the run does not miss it.
    recent = str(tmp_path / "recent")
    spark.read.parquet(path).where(ind.F.col("day") >= ind.F.lit(first_read)).write.parquet(recent)
    update = ind.indicators_daily(spark.read.parquet(recent), arrived, blocks, arrived.limit(0).select("code"), [5])
    _near(update.added, ind.indicators(spark.read.parquet(path), [5]).where(f"code = 'a' and day >= date '{days[2440]}'"))
    again = spark.read.parquet(path).where(ind.F.col("day") >= ind.F.lit(first_read))
    assert f"GreaterThanOrEqual(day,{first_read})" in again._jdf.queryExecution().executedPlan().toString()
    assert 0 < (first_read - days[0]).days and first_read <= days[2440]


def test_rounding_is_that_of_sql_without_a_decimal_for_each_value(spark):
    import duckdb

    from candlemill.registry.series import _round, _rounded_indicators

    values = [0.0625, -0.0625, 0.1875, 62.5, -0.5, 0.0004999, 1234567.8915, -3.0015, 0.0, 100.0, 1e12 + 0.25, None]
    values += [(n * 7919 % 100003) / 977 - 40 for n in range(2000)]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, x double")
    found = [tuple(r) for r in df.select("n", _round(F.col("x"), 3), _round(F.col("x"), 6)).orderBy("n").collect()]
    con = duckdb.connect()
    wanted = [(n, *con.execute("select round(?::double, 3), round(?::double, 6)", [v, v]).fetchall()[0]) for n, v in enumerate(values)]
    for here, there in zip(found, wanted, strict=True):
        assert here == there or here == pytest.approx(there, rel=1e-15)
    columns = [F.lit(1.5).alias(name) for name in ind.indicator_columns()]
    rounded = _rounded_indicators(spark.range(3).select("id", F.lit(1).alias("code"), F.lit(2).alias("day"), *columns))
    assert "round(" not in rounded._jdf.queryExecution().analyzed().toString()
