"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract
from candlemill.operators.ewm import ewm_means
from candlemill.operators.keyed import delete_ranges, drop_listed, keep_listed, subtract_rows, top_per_key
from candlemill.plans.ingest import new_prices, purge_old, rebased_codes, rows_after_stored
from candlemill.registry.base import daily_series, table
from candlemill.registry.ingest import _answers
from candlemill.workspace import written


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_cross_join(spark, smallest, name):
    plan = plan_of(contract.queries()[name](spark, smallest))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.fixture
def hot(spark):
    """Rows of which a third have one key, and settings that make a small partition count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark.range(200_000).selectExpr(
        "if(id % 3 = 0, 7, id % 2000) as code", "date_add(date '2000-01-01', int(id % 5000)) as day", "id as v"
    ).repartition(8)
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


HOT_JOINS = {
    "keep_listed": lambda df: keep_listed(df, "code", df.where("code > 5")),
    "drop_listed": lambda df: drop_listed(df, "code", df.where("code > 1000")),
    "rows_after_stored": lambda df: rows_after_stored(df, df.where("v < 100000"), "code", "day"),
    "delete_ranges": lambda df: delete_ranges(
        df, "code", "day", df.selectExpr("code", "day as `from`", "date_add(day, 1) as to").where("v % 50 = 0")
    ),
    "subtract_rows": lambda df: subtract_rows(df.select("code"), df.select("code").where("code > 1000")),
}


@pytest.mark.parametrize("name", sorted(HOT_JOINS))
def test_a_hot_key_is_split(hot, name):
    plan = executed_plan_of(HOT_JOINS[name](hot))
    assert "SortMergeJoin(skew=true)" in plan


def test_top_per_key_limits_before_the_shuffle_for_any_n(spark, smallest):
    events = table(spark, smallest, "events").select("user_id", "event_id", "value")
    plan = plan_of(top_per_key(events, ["user_id"], [events["value"].desc(), events["event_id"]], 5000))
    assert plan.count("Window [") == 2 and "pmod(xxhash64" in plan


def test_latest_per_key_scans_once_and_limits_before_the_shuffle(spark, smallest):
    plan = plan_of(contract.queries()["latest_per_key"](spark, smallest))
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_insert_ignore_reads_the_range_of_the_batch(spark, smallest):
    df = contract.queries()["insert_ignore"](spark, smallest)
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line and "l_returnflag" in line)
    assert "GreaterThanOrEqual(l_orderkey" in pushed and "LessThanOrEqual(l_orderkey" in pushed


def test_top_per_key_limits_before_the_shuffle(spark, smallest):
    events = table(spark, smallest, "events").select("user_id", "event_id", "value")
    plan = plan_of(top_per_key(events, ["user_id"], [events["value"].desc(), events["event_id"]]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_weighted_means_shuffle_the_rows_once(spark, smallest):
    series = spark.read.parquet(f"{smallest}/lineitem.parquet").selectExpr(
        "l_orderkey as code", "to_date(l_shipdate) as day", "l_quantity as close"
    )
    plan = executed_plan_of(ewm_means(series, "code", "day", ["close"], [5, 20]))
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "Python" not in final and "Pandas" not in final


def test_scans_read_only_what_they_need(spark, smallest):
    plan = plan_of(daily_series(spark, smallest))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
    }


def test_retention_cutoff_reaches_the_scan(spark, smallest):
    import datetime

    plan = plan_of(purge_old(table(spark, smallest, "orders"), "o_orderdate", datetime.date(2008, 1, 1)))
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, smallest):
    plan = plan_of(contract.queries()["bucketed_join"](spark, smallest))
    assert "Exchange hashpartitioning" not in plan


def test_the_daily_run_broadcasts_no_rows(spark, rows):
    """Windows, prices and keys compress so well that their files pass for small tables."""
    spans = "code", "cast(date '1969-06-01' + cast(id as int) as date) as `from`", "cast(date '1969-06-01' + cast(id + 70 as int) as date) as `to`"
    asked = written(spark.range(0, 800, 90).selectExpr("id", "id div 270 as code").selectExpr("id", *spans).drop("id"), "asked")
    served = written(spark.range(4000).selectExpr("id % 4 as code", "date_add(date '1969-05-01', int(id div 4)) as day", "id as close"), "served")
    found = _answers(served, asked)
    assert rows(found) == rows(served.join(asked.selectExpr("code", "explode(sequence(`from`, `to`)) as day"), ["code", "day"], "left_semi"))
    for df in (found, rebased_codes(served, served, "code", "day", "close"), new_prices(served, served)):
        plan = executed_plan_of(df)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
