"""Scalar helpers and the window cutter."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from candlemill import functions as fn
from candlemill.plans.ingest import cut_windows

D = datetime.date.fromisoformat


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,wanted", [("a/b", "b"), ("b", "b"), ("a/b/c", "c"), ("a/", ""), (None, None), ("", "")])
def test_last_segment(spark, text, wanted):
    assert one(spark, text, fn.last_segment) == wanted


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("2024-05-19T14:00:01Z", datetime.datetime(2024, 5, 19, 14, 0, 1)),
        ("2024-13-19T14:00:01Z", None),
        ("noon", None),
        (None, None),
    ],
)
def test_clean_event_time(spark, text, wanted):
    assert one(spark, text, lambda c: fn.clean_event_time(c).cast("timestamp_ntz")) == wanted


@pytest.mark.parametrize("text,wanted", [("20240229", D("2024-02-29")), ("20230229", None), ("x", None), (None, None)])
def test_compact_dates(spark, text, wanted):
    assert one(spark, text, fn.parse_compact_date) == wanted


def test_percent_of_zero_is_null(spark):
    rows = spark.createDataFrame([(1, 0), (0, 0), (1, 4)], "a int, b int")
    assert [r["p"] for r in rows.select(fn.percent_of(F.col("a"), F.col("b")).alias("p")).collect()] == [None, None, 25.0]


@pytest.mark.parametrize("text,wanted", [(None, True), ("", True), (" ", False), ("20240101", False)])
def test_is_blank(spark, text, wanted):
    assert one(spark, text, fn.is_blank) is wanted


def windows(spark, pairs, days, legacy=False):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, s date, e date")
    found = cut_windows(df, "s", F.col("e"), days, legacy).collect()
    return {i: sorted((r["from"], r["to"]) for r in found if r["i"] == i) for i in range(len(pairs))}


def test_windows_cover_the_range_once(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(200):
        start = D("2020-01-01") + datetime.timedelta(days=rng.randrange(1000))
        pairs.append((start, start + datetime.timedelta(days=rng.randrange(-2, 120))))
    for days in (1, 7, 30):
        for i, cut in windows(spark, pairs, days).items():
            start, end = pairs[i]
            covered = [a + datetime.timedelta(days=k) for a, b in cut for k in range((b - a).days + 1)]
            wanted = [start + datetime.timedelta(days=k) for k in range((end - start).days + 1)]
            assert covered == wanted
            assert all((b - a).days < days for a, b in cut)


def test_legacy_tail_loses_a_single_last_day(spark):
    pairs = [(D("2024-01-01"), D("2024-01-31")), (D("2024-01-01"), D("2024-01-01")), (D("2024-01-01"), D("2024-02-01"))]
    found = windows(spark, pairs, 30, legacy=True)
    assert found[0] == [(D("2024-01-01"), D("2024-01-30"))]
    assert found[1] == []
    assert found[2] == [(D("2024-01-01"), D("2024-01-30")), (D("2024-01-31"), D("2024-02-01"))]
    inclusive = windows(spark, pairs, 30)
    assert inclusive[0][-1] == (D("2024-01-31"), D("2024-01-31"))
    assert inclusive[1] == [(D("2024-01-01"), D("2024-01-01"))]
