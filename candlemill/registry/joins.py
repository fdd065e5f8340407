"""Joins, set operations, keyed operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill.operators.grouping import cogrouped_values
from candlemill.operators.keyed import (
    insert_ignore,
    last_value_per_key,
    latest_per_key,
    subtract_rows,
    top_per_key,
)
from candlemill.registry.base import DAILY_SERIES, daily_series, query, table


@query(
    "join_left_multi",
    f"""with s as ({DAILY_SERIES}) select s.code, s.day, s.close, t.volume from s
        left join (select * from s where volume > 30) t on s.code = t.code and s.day = t.day and s.close = t.close""",
)
def _join_left_multi(spark, d):
    series = daily_series(spark, d)
    large = series.where("volume > 30")
    return series.drop("volume").join(large, ["code", "day", "close"], "left")


@query(
    "join_left_anti",
    """select c_custkey from customer where not exists
       (select 1 from orders where o_orderstatus = 'F' and o_custkey = c_custkey)""",
)
def _join_left_anti(spark, d):
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(finished.distinct(), "c_custkey", "left_anti")


@query(
    "join_left_semi",
    """select c_custkey from customer where exists
       (select 1 from orders where o_orderstatus = 'F' and o_custkey = c_custkey)""",
)
def _join_left_semi(spark, d):
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(finished.distinct(), "c_custkey", "left_semi")


@query(
    "join_inner",
    "select o_orderkey, o_orderdate, l_linenumber, l_quantity from orders join lineitem on o_orderkey = l_orderkey",
)
def _join_inner(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


@query(
    "join_cogroup",
    """select coalesce(a.k, b.k) as k, coalesce(a.v, b.v) as v, coalesce(l, 0) as left_copies, coalesce(r, 0) as right_copies
       from (select 100 + c_nationkey % 20 as k, c_mktsegment as v, count(*) as l from customer group by 1, 2) a
       full join (select 105 + s_nationkey % 20 as k, case when s_suppkey % 2 = 0 then 'MACHINERY' else s_name end as v,
                         count(*) as r from supplier group by 1, 2) b on a.k = b.k and a.v = b.v""",
)
def _join_cogroup(spark, d):
    """Keys 100 to 104 are on the left side only, 120 to 124 on the right side only."""
    left = table(spark, d, "customer").select((F.col("c_nationkey") % 20 + 100).alias("k"), F.col("c_mktsegment").alias("v"))
    name = F.when(F.col("s_suppkey") % 2 == 0, "MACHINERY").otherwise(F.col("s_name"))
    right = table(spark, d, "supplier").select((F.col("s_nationkey") % 20 + 105).alias("k"), name.alias("v"))
    return cogrouped_values(left, right, "k", "v")


@query(
    "latest_per_key",
    """select user_id, event_id, ts from
       (select *, rank() over (partition by user_id order by ts desc) r from events) where r = 1""",
)
def _latest_per_key(spark, d):
    return latest_per_key(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts")


@query(
    "top2000_per_group",
    """select event_type, event_id from (select *, row_number() over (
           partition by event_type order by value desc, event_id) r from events) where r <= 2000""",
)
def _top2000_per_group(spark, d):
    events = table(spark, d, "events").select("event_type", "event_id", "value")
    return top_per_key(events, ["event_type"], [F.col("value").desc(), F.col("event_id")], 2000).drop("value")


@query("last_date_for_code", "select l_suppkey, cast(max(l_shipdate) as date) as last_day from lineitem group by 1")
def _last_date_for_code(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    return last_value_per_key(lines, ["l_suppkey"], "day", "last_day")


@query(
    "top1_per_group",
    """select user_id, event_id from
       (select *, row_number() over (partition by user_id order by value desc, event_id) r from events) where r = 1""",
)
def _top1_per_group(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "value")
    return top_per_key(events, ["user_id"], [F.col("value").desc(), F.col("event_id")]).drop("value")


@query(
    "insert_ignore",
    """select * from (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey from lineitem group by 1, 2) n
       where not exists (select 1 from lineitem t where t.l_returnflag = 'A'
                         and n.l_orderkey = t.l_orderkey and n.l_linenumber = t.l_linenumber)""",
)
def _insert_ignore(spark, d):
    lines = table(spark, d, "lineitem")
    batch = lines.select("l_orderkey", "l_linenumber", "l_partkey")
    stored = lines.where("l_returnflag = 'A'")
    return insert_ignore(stored, batch, ["l_orderkey", "l_linenumber"], within="l_orderkey")


@query(
    "set_union_all",
    "select c_custkey as k, c_name as name from customer union all select s_suppkey, s_name from supplier",
)
def _set_union_all(spark, d):
    left = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return left.unionByName(
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    )


@query(
    "set_union_missing",
    """select c_custkey as k, c_name, cast(null as varchar) as p_name from customer
       union all select p_partkey, null, p_name from part""",
)
def _set_union_missing(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return customers.unionByName(parts, allowMissingColumns=True)


@query(
    "set_subtract",
    """select o_custkey from orders where not exists
       (select 1 from customer where c_mktsegment = 'BUILDING' and c_custkey is not distinct from o_custkey)""",
)
def _set_subtract(spark, d):
    building = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    return subtract_rows(
        table(spark, d, "orders").select("o_custkey"), building.select(F.col("c_custkey").alias("o_custkey"))
    )


@query("set_except", "select c_custkey as k from customer except select o_custkey from orders where o_orderstatus = 'F'")
def _set_except(spark, d):
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(finished)


@query(
    "set_intersect",
    "select c_custkey as k from customer intersect select o_custkey from orders where o_orderstatus = 'F'",
)
def _set_intersect(spark, d):
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).intersect(finished)
