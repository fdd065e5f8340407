"""Aggregates, lists, combiners, text statistics, top-n."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.grouping import combine_by_key, grouped_values, lists_per_key
from candlemill.operators.profile import (
    column_summary,
    counts_by,
    exact_summary,
    hash_bucket_rows,
    partition_rows,
    partition_sizes,
)
from candlemill.plans.textstats import lines_with, word_count
from candlemill.registry.base import query, table


# Relative error that the sketch is asked for.
APPROXIMATION = 0.05


@query("agg_count", "select count(*) as n from lineitem")
def _agg_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query(
    "agg_count_if",
    """select l_suppkey, count(*) filter (l_returnflag = 'R') as returned,
              count(*) filter (l_quantity > 25) as large from lineitem group by 1""",
)
def _agg_count_if(spark, d):
    return counts_by(
        table(spark, d, "lineitem"),
        ["l_suppkey"],
        {"returned": F.col("l_returnflag") == "R", "large": F.col("l_quantity") > 25},
    )


@query(
    "agg_minmax",
    """select min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, min(l_extendedprice) as low,
              max(l_extendedprice) as high from lineitem""",
)
def _agg_minmax(spark, d):
    return table(spark, d, "lineitem").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )


@query("agg_group_max", "select event_type, max(ts) as last_ts from events group by 1")
def _agg_group_max(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.max("ts").alias("last_ts"))


@query(
    "agg_count_distinct",
    "select p_type, count(distinct p_brand) as brands from part group by 1",
)
def _agg_count_distinct(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.count_distinct("p_brand").alias("brands"))


@query("agg_count_distinct_all", "select count(distinct l_partkey) as parts from lineitem")
def _agg_count_distinct_all(spark, d):
    return table(spark, d, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"))


@query("agg_approx_distinct", "select count(distinct l_orderkey) as exact, true as held from lineitem")
def _agg_approx_distinct(spark, d):
    """The sketch is held against the exact count: three times its stated error at most."""
    found = table(spark, d, "lineitem").agg(
        F.approx_count_distinct("l_orderkey", APPROXIMATION).alias("guess"), F.count_distinct("l_orderkey").alias("exact")
    )
    held = F.abs(F.col("guess") - F.col("exact")) <= 3 * APPROXIMATION * F.col("exact")
    return found.select("exact", held.alias("held"))


@query("agg_approx_distinct_rows")
def _agg_approx_distinct_rows(spark, d):
    """The sketch's own value for each flag and status; ``agg_approx_distinct`` holds it against the exact count."""
    guess = F.approx_count_distinct("l_orderkey", APPROXIMATION).alias("orders")
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(guess)


@query("agg_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def _agg_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "agg_group_only",
    "select count(*) as n from (select p_brand, p_type from part group by 1, 2) where p_brand > 'Brand#2'",
)
def _agg_group_only(spark, d):
    pairs = table(spark, d, "part").select("p_brand", "p_type").distinct()
    return pairs.where("p_brand > 'Brand#2'").agg(F.count("*").alias("n"))


@query("agg_value_counts", "select p_name, count(*) as n from part group by 1")
def _agg_value_counts(spark, d):
    return table(spark, d, "part").groupBy("p_name").agg(F.count("*").alias("n"))


@query("agg_reduce", "select cast(sum(l_quantity) as bigint) as quantity from lineitem")
def _agg_reduce(spark, d):
    return table(spark, d, "lineitem").agg(F.sum("l_quantity").cast("long").alias("quantity"))


@query(
    "agg_collect_list",
    "select user_id, event_type, count(*) as copies from events group by 1, 2",
)
def _agg_collect_list(spark, d):
    return grouped_values(table(spark, d, "events"), "user_id", "event_type")


@query(
    "agg_lists",
    """select user_id, chunk, array_to_string(list(event_id order by event_id), ',') as ids
       from (select user_id, event_id, (row_number() over (partition by user_id order by event_id) - 1) // 3 as chunk
             from events) group by 1, 2""",
)
def _agg_lists(spark, d):
    lists = lists_per_key(table(spark, d, "events"), "user_id", "event_id", max_len=3)
    return lists.select("user_id", "chunk", F.array_join("event_id", ",").alias("ids"))


def _first_moment(value: float | None) -> tuple:
    return (0, 0.0, 0.0) if value is None else (1, value, 0.0)


def _merged_moments(a: tuple, b: tuple) -> tuple:
    """Count, mean and sum of squared deviations of two parts together."""
    n = a[0] + b[0]
    if n == 0:
        return a
    delta = b[1] - a[1]
    return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta * delta * a[0] * b[0] / n


def _with_value(a: tuple, value: float | None) -> tuple:
    return _merged_moments(a, _first_moment(value))


@query(
    "udaf_custom",
    """select user_id, count(value) as n, round(avg(value) + 1e-9, 6) as mean, round(var_pop(value) + 1e-9, 6) as variance
       from events group by 1""",
)
def _udaf_custom(spark, d):
    state = T.StructType.fromDDL("n bigint, mean double, m2 double")
    moments = combine_by_key(
        table(spark, d, "events"), "user_id", "value", _first_moment, _with_value, _merged_moments, state
    )
    return moments.select(
        "user_id",
        "n",
        F.round(F.col("mean") + 1e-9, 6).alias("mean"),
        F.round(F.try_divide("m2", "n") + 1e-9, 6).alias("variance"),
    )


@query(
    "agg_summary",
    """select 'l_quantity' as "column", count(l_quantity) as n, round(avg(l_quantity), 6) as mean,
              round(stddev(l_quantity), 6) as stddev, min(l_quantity) as "min", max(l_quantity) as "max" from lineitem
       union all
       select 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6),
              round(stddev(l_extendedprice), 6), min(l_extendedprice), max(l_extendedprice) from lineitem""",
)
def _agg_summary(spark, d):
    summary = column_summary(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return summary.select(
        "column", "n", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max"
    )


@query("partition_size_rows")
def _partition_size_rows(spark, d):
    """Each of ten partitions with its rows; ``partition_sizes`` holds their sum and range against SQL."""
    return partition_sizes(table(spark, d, "lineitem").repartition(10, "l_suppkey"))


@query(
    "partition_arrays",
    """select cast(l_suppkey % 10 as integer) as partition,
              row_number() over (partition by l_suppkey % 10 order by l_orderkey, l_linenumber) - 1 as place, l_orderkey, l_linenumber
       from lineitem""",
)
def _partition_arrays(spark, d):
    """What each of ten partitions holds, in its order."""
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    dealt = rows.repartitionById(10, (F.col("l_suppkey") % 10).cast("int")).sortWithinPartitions("l_orderkey", "l_linenumber")
    return partition_rows(dealt.select("l_orderkey", "l_linenumber"))


@query("partition_sizes", "select count(*) as total, true as within from lineitem")
def _partition_sizes(spark, d):
    """Sizes of ten partitions: they add up, and every partition is one of the ten."""
    sizes = partition_sizes(table(spark, d, "lineitem").repartition(10, "l_suppkey"))
    within = F.every(F.col("partition").between(0, 9) & (F.col("rows") > 0)) & (F.count("*") <= 10)
    return sizes.agg(F.sum("rows").alias("total"), within.alias("within"))


@query("hash_bucket_rows")
def _hash_bucket_rows(spark, d):
    """Each of twenty buckets; ``hash_bucket`` holds their sums and range against SQL."""
    found = hash_bucket_rows(table(spark, d, "lineitem"), ["l_suppkey"], 20)
    return found.select("bucket", "rows", "keys", F.col("first.l_suppkey").alias("first"), F.col("last.l_suppkey").alias("last"))


@query("hash_bucket", "select count(*) as total, count(distinct l_suppkey) as keys, true as within from lineitem")
def _hash_bucket(spark, d):
    """Twenty buckets by hash: they add up, every bucket is in range, and a key is in one bucket."""
    bucket = F.pmod(F.hash("l_suppkey"), F.lit(20)).alias("bucket")
    sizes = table(spark, d, "lineitem").groupBy(bucket).agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("keys"))
    return sizes.agg(
        F.sum("n").alias("total"), F.sum("keys").alias("keys"), F.every(F.col("bucket").between(0, 19)).alias("within")
    )


QUARTILED = ("l_quantity", "l_discount", "l_extendedprice", "l_orderkey")


@query(
    "agg_quartiles",
    " union all ".join(
        f"""select '{name}' as "column", cast(quantile_disc({name}, 0.25) as double) as q1,
                   cast(quantile_disc({name}, 0.5) as double) as median, cast(quantile_disc({name}, 0.75) as double) as q3
            from lineitem"""
        for name in QUARTILED
    ),
)
def _agg_quartiles(spark, d):
    """Exact, in columns of few values and of nearly as many as rows."""
    return exact_summary(table(spark, d, "lineitem"), QUARTILED).select("column", "q1", "median", "q3")


@query(
    "agg_quartiles_approx",
    """select 'l_quantity' as "column", quantile_disc(l_quantity, 0.25) as q1, quantile_disc(l_quantity, 0.5) as median,
              quantile_disc(l_quantity, 0.75) as q3 from lineitem
       union all select 'l_discount', quantile_disc(l_discount, 0.25), quantile_disc(l_discount, 0.5),
                        quantile_disc(l_discount, 0.75) from lineitem""",
)
def _agg_quartiles_approx(spark, d):
    """In one scan, by sketch: columns with few values, where the approximation has no room to differ."""
    return column_summary(table(spark, d, "lineitem"), ["l_quantity", "l_discount"]).select("column", "q1", "median", "q3")


@query(
    "text_lines_count",
    """select count(*) filter (contains(text, 'a')) as a, count(*) filter (contains(text, 'b')) as b
       from documents""",
)
def _text_lines_count(spark, d):
    return lines_with(table(spark, d, "documents"), ["a", "b"], "text")


@query(
    "word_count",
    "select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from documents) group by 1",
)
def _word_count(spark, d):
    return word_count(table(spark, d, "documents"), "text")


@query("sort_asc", "select event_id, value from events order by value, event_id")
def _sort_asc(spark, d):
    return table(spark, d, "events").select("event_id", "value").orderBy("value", "event_id")


@query(
    "sort_desc_topn",
    """select p_type, count(distinct p_name) as names from part group by 1
       order by names desc, p_type limit 3""",
)
def _sort_desc_topn(spark, d):
    names = table(spark, d, "part").groupBy("p_type").agg(F.count_distinct("p_name").alias("names"))
    return names.orderBy(F.desc("names"), "p_type").limit(3)


@query("sort_hidden_col", "select o_orderkey from orders order by o_totalprice desc, o_orderkey limit 10")
def _sort_hidden_col(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey")


@query("take_ordered", "select o_totalprice from orders order by o_totalprice limit 5")
def _take_ordered(spark, d):
    return table(spark, d, "orders").select("o_totalprice").orderBy("o_totalprice").limit(5)


@query("take_top", "select o_totalprice from orders order by o_totalprice desc limit 3")
def _take_top(spark, d):
    return table(spark, d, "orders").select("o_totalprice").orderBy(F.desc("o_totalprice")).limit(3)
