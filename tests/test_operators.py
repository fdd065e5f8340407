"""Keyed operators, lists, combiners and profiles on small hand-made frames."""

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators import grouping, keyed, profile

D = lambda text: datetime.date.fromisoformat(text)


def test_latest_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w")], ["k", "t", "v"])
    assert rows(keyed.latest_per_key(df, ["k"], "t")) == [("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w")]


def test_top_per_key_breaks_ties_by_order(spark, rows):
    df = spark.createDataFrame([("a", 2, 1), ("a", 2, 0), ("a", 1, 9), ("b", 7, 3)], ["k", "v", "id"])
    assert rows(keyed.top_per_key(df, ["k"], [F.desc("v"), F.col("id")])) == [("a", 2, 0), ("b", 7, 3)]
    assert keyed.top_per_key(df, ["k"], [F.desc("v"), F.col("id")], 2).count() == 3


def test_subtract_keeps_duplicates_and_matches_nulls(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "x int, y string")
    right = spark.createDataFrame([("c", 3), (None, 2), (None, 2)], "y string, x int")
    assert rows(keyed.subtract_rows(left, right)) == [(1, "a"), (1, "a")]
    assert keyed.subtract_rows(left, left.limit(0)).count() == 4
    assert keyed.subtract_rows(left, left).count() == 0


def test_insert_ignore_is_idempotent(spark, rows):
    target = spark.createDataFrame([("a", 1, 10)], ["code", "day", "v"])
    batch = spark.createDataFrame([("a", 1, 99), ("a", 2, 7), ("a", 2, 5), ("b", 1, 3)], ["code", "day", "v"])
    added = keyed.insert_ignore(target, batch, ["code", "day"])
    assert rows(added) == [("a", 2, 5), ("b", 1, 3)]
    assert keyed.insert_ignore(target.unionByName(added), batch, ["code", "day"]).count() == 0


def test_one_row_per_key_without_other_columns(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], ["k"])
    assert rows(keyed.one_row_per_key(df, ["k"])) == [(1,), (2,)]


def test_ranges_merge_and_delete(spark, rows):
    ranges = spark.createDataFrame(
        [
            ("a", D("2024-01-01"), D("2024-01-10")),
            ("a", D("2024-01-05"), D("2024-01-07")),
            ("a", D("2024-01-11"), D("2024-01-12")),
            ("a", D("2024-02-01"), D("2024-02-02")),
            ("b", D("2024-03-05"), D("2024-03-01")),
        ],
        ["k", "from", "to"],
    )
    assert rows(keyed.merged_ranges(ranges, "k")) == [
        ("a", D("2024-01-01"), D("2024-01-12")),
        ("a", D("2024-02-01"), D("2024-02-02")),
    ]
    df = spark.createDataFrame(
        [("a", D("2024-01-12")), ("a", D("2024-01-13")), ("b", D("2024-03-02")), ("c", D("2024-01-01")), ("a", None)],
        ["k", "day"],
    )
    assert rows(keyed.delete_ranges(df, "k", "day", ranges)) == [
        ("a", None),
        ("a", D("2024-01-13")),
        ("b", D("2024-03-02")),
        ("c", D("2024-01-01")),
    ]


def test_until_second_empty(spark, rows):
    windows = spark.createDataFrame(
        [("a", 5, 0), ("a", 4, 3), ("a", 3, 2), ("a", 2, 0), ("a", 1, 9), ("b", 2, 1), ("b", 1, 4)], ["k", "w", "n"]
    )
    assert rows(keyed.until_second_empty(windows, ["k"], "w", "n")) == [
        ("a", 3, 2),
        ("a", 4, 3),
        ("b", 1, 4),
        ("b", 2, 1),
    ]


def skewed(seed=1, n=3_000):
    """A third of the rows under one key, a third of those copies of one value."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"])
        value = 7 if i % 9 == 0 else rng.choice([None, *range(500)])
        data.append((key, value))
    return data


def in_order(values):
    return sorted(values, key=lambda v: (v is not None, v))


@pytest.mark.parametrize("max_len", [3, 50, 10_000])
def test_lists_are_the_values_in_order_cut_alike(spark, max_len):
    data = skewed()
    df = spark.createDataFrame(data, "k string, v int").repartition(5)
    found = {}
    for row in grouping.lists_per_key(df, "k", "v", max_len).collect():
        found.setdefault(row["k"], {})[row["chunk"]] = row["v"]
    for key in {k for k, _ in data}:
        values = in_order([v for k, v in data if k == key])
        wanted = {at // max_len: values[at : at + max_len] for at in range(0, len(values), max_len)}
        assert found[key] == wanted


def test_grouped_values(spark):
    data = skewed(2)
    found = grouping.grouped_values(spark.createDataFrame(data, "k string, v int"), "k", "v").collect()
    assert {(r["k"], r["v"]): r["copies"] for r in found} == collections.Counter(data)


def test_cogroup_of_both_sides(spark):
    left, right = skewed(2), [*skewed(4)[:1000], ("only right", 1), ("only right", 1)]
    frames = (spark.createDataFrame(data, "k string, v int") for data in (left, right))
    found = grouping.cogrouped_values(*frames, "k", "v").collect()
    assert {(r["k"], r["v"]): r["left_copies"] for r in found if r["left_copies"]} == collections.Counter(left)
    assert {(r["k"], r["v"]): r["right_copies"] for r in found if r["right_copies"]} == collections.Counter(right)


def test_combine_by_key_joins_nan_keys_and_any_number_held_gives_the_same(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (nan, 2), (1.0, 3), (nan, 4), (None, 5), (-0.0, 6), (0.0, 7)], "k double, v int").repartition(3)
    state = T.StructType([T.StructField("total", T.LongType())])
    for held in (1, 2, 50_000):
        sums = grouping.combine_by_key(
            df, "k", "v", lambda v: (v,), lambda a, v: (a[0] + v,), lambda a, b: (a[0] + b[0],), state, max_held=held
        )
        assert sorted((str(r["k"]), r["total"]) for r in sums.collect()) == [("0.0", 13), ("1.0", 3), ("None", 5), ("nan", 7)]


def test_combine_by_key_of_a_hot_key(spark):
    data = skewed(3)
    df = spark.createDataFrame(data, "k string, v int").repartition(7)
    state = T.StructType([T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])

    combined = grouping.combine_by_key(
        df,
        "k",
        "v",
        create=lambda v: (1, v or 0),
        merge_value=lambda a, v: (a[0] + 1, a[1] + (v or 0)),
        merge_states=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        state=state,
    ).collect()
    found = {row["k"]: (row["n"], row["total"]) for row in combined}
    assert len(found) == len(combined)
    wanted = collections.defaultdict(lambda: (0, 0))
    for key, value in data:
        n, total = wanted[key]
        wanted[key] = (n + 1, total + (value or 0))
    assert found == dict(wanted)


def test_combine_by_key_to_lists(spark):
    data = [("Math", 100), ("Eng", 80), ("Math", 50), ("Eng", 70), ("Eng", 90)]
    state = T.StructType([T.StructField("scores", T.ArrayType(T.LongType()))])
    df = spark.createDataFrame(data, "k string, v bigint").repartition(3)
    lists = grouping.combine_by_key(
        df, "k", "v", lambda v: ([v],), lambda a, v: (a[0] + [v],), lambda a, b: (a[0] + b[0],), state
    )
    assert {r["k"]: sorted(r["scores"]) for r in lists.collect()} == {"Math": [50, 100], "Eng": [70, 80, 90]}


def test_summary(spark):
    df = spark.createDataFrame([(float(i), None if i == 0 else i) for i in range(101)], "x double, y int")
    x, y = profile.column_summary(df, ["x", "y"]).collect()
    assert (x["column"], x["n"], x["mean"], x["min"], x["max"]) == ("x", 101, 50.0, 0.0, 100.0)
    assert (x["q1"], x["median"], x["q3"]) == (25.0, 50.0, 75.0)
    assert (y["n"], y["min"]) == (100, 1.0)


def test_schema_frame(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.schema_frame(df)) == [("a", "int", True, 2), ("b", "string", True, 1)]


def test_foreach_partition_is_available_to_custom_sinks(spark):
    seen = spark.sparkContext.accumulator(0)

    def sink(part):
        seen.add(sum(1 for _ in part))

    spark.range(100).repartition(4).foreachPartition(sink)
    assert seen.value == 100


def test_worker_functions_need_no_package_on_the_executor(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from candlemill.registry.aggregates import _with_value
    from candlemill.sources.master import _decoder

    for function in (_with_value, _decoder("cp949")):
        subprocess.run(
            [sys.executable, "-c", "import pickle, sys; assert callable(pickle.load(sys.stdin.buffer))"],
            input=cloudpickle.dumps(function),
            cwd=tmp_path,
            check=True,
        )
