"""Round trips through files, the catalog, inline rows and ranges."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from candlemill.operators.profile import partition_sizes
from candlemill.registry.base import TABLES, query, table
from candlemill.sinks.tables import export_csv, save_bucketed
from candlemill.sources.catalog import table_list
from candlemill.sources.files import expired_files
from candlemill.sources.master import (
    CODE_PAGE,
    HEAD_WIDTHS,
    MAIN_MARKET,
    SECOND_MARKET,
    Layout,
    read_main_market,
    read_second_market,
)
from candlemill.workspace import new_folder, new_table, written


@query("src_csv_roundtrip", "select p_partkey, p_name, p_brand, p_size, p_retailprice from part")
def _src_csv_roundtrip(spark, d):
    folder = new_folder(spark, "csv")
    parts = table(spark, d, "part").select("p_brand", "p_partkey", "p_name", "p_size", "p_retailprice")
    export_csv(parts, folder, "p_brand", "p_partkey")
    reader = spark.read.options(header="true", sep=",", basePath=folder)
    shape = "p_partkey bigint, p_name string, p_size int, p_retailprice double, p_brand string"
    return reader.schema(shape).csv(f"{folder}/*")


@query(
    "src_inline_rows",
    """select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' when 'P' then 'pending' end
       as label from orders""",
)
def _src_inline_rows(spark, d):
    labels = spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "pending")], ["o_orderstatus", "label"])
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(labels, "o_orderstatus", "left").drop("o_orderstatus")


@query(
    "src_rows_of_all_kinds",
    """select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 2 when 'P' then 3 end as place,
              o_orderstatus = 'F' as closed from orders""",
)
def _src_rows_of_all_kinds(spark, d):
    """The same small table from Row objects, from mappings and from pandas."""
    data = [("F", 1, True), ("O", 2, False), ("P", 3, False)]
    names = ["o_orderstatus", "place", "closed"]
    kinds = [
        spark.createDataFrame([Row(**dict(zip(names, row))) for row in data]),
        spark.createDataFrame([dict(zip(names, row)) for row in data]).select(*names),
        spark.createDataFrame(pd.DataFrame(data, columns=names)),
    ]
    same = functools.reduce(DataFrame.intersect, kinds).withColumn("place", F.col("place").cast("int"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(same, "o_orderstatus", "left").drop("o_orderstatus")


@query("drop_table", "select o_orderkey, o_custkey, o_orderstatus, true as dropped from orders")
def _drop_table(spark, d):
    """A catalog table is created, read and dropped; its rows were written elsewhere before."""
    name = new_table("dropped")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = written(save_bucketed(orders, name, new_folder(spark, "dropped"), "o_custkey", 4), "rows")
    spark.sql(f"DROP TABLE {name}")
    return rows.withColumn("dropped", F.lit(not spark.catalog.tableExists(name)))


@query(
    "src_range_sum",
    """select cast(sum(id) as bigint) as total, count(*) as n from (
           select unnest(range((select min(o_orderkey) from orders), (select max(o_orderkey) + 1 from orders))) as id)
       where id not in (select o_orderkey from orders where o_orderstatus = 'F')""",
)
def _src_range_sum(spark, d):
    orders = table(spark, d, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    missing = spark.range(low, high + 1, 1, 10).join(finished, "id", "left_anti")
    return missing.agg(F.sum("id").alias("total"), F.count("*").alias("n"))


@query("src_table_limit", "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 10")
def _src_table_limit(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    saved = save_bucketed(orders, "candlemill_bucketed_orders", new_folder(spark, "bucketed"), "o_orderkey", 8)
    return saved.orderBy("o_orderkey").limit(10)


@query(
    "bucketed_join",
    """select o_orderkey, count(*) as n, cast(sum(l_quantity) as bigint) as quantity
       from orders join lineitem on o_orderkey = l_orderkey group by 1""",
)
def _bucketed_join(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    left = save_bucketed(orders, "candlemill_bucketed_order_keys", new_folder(spark, "bucketed"), "o_orderkey", 8)
    right = save_bucketed(lines, "candlemill_bucketed_order_lines", new_folder(spark, "bucketed"), "o_orderkey", 8)
    grouped = left.join(right, "o_orderkey").groupBy("o_orderkey")
    return grouped.agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(
    "catalog_tables",
    " union all ".join(
        f"select 'candlemill_view_{name}' as name, 'TEMPORARY' as table_type, true as temporary, count(*) as n from {name}"
        for name in TABLES
    ),
)
def _catalog_tables(spark, d):
    """The listing of the session's views, each with the rows that it gives."""
    for name in TABLES:
        table(spark, d, name).createOrReplaceTempView(f"candlemill_view_{name}")
    listed = table_list(spark).where(F.col("temporary") & F.col("name").startswith("candlemill_view_"))
    counts = [spark.sql(f"SELECT 'candlemill_view_{name}' AS name, count(*) AS n FROM candlemill_view_{name}") for name in TABLES]
    return listed.join(functools.reduce(DataFrame.unionByName, counts), "name")


@query(
    "src_csv_inferred",
    """select 'int' as key_type, 'string' as name_type, 'int' as size_type, 'double' as price_type, count(*) as n,
              cast(sum(p_size) as bigint) as sizes from part""",
)
def _src_csv_inferred(spark, d):
    """Types are found by a pass over the data."""
    folder = new_folder(spark, "csv")
    table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", "true").csv(folder)
    found = spark.read.options(header="true", inferSchema="true").csv(folder)
    types = {name: F.lit(kind) for name, kind in zip(("key_type", "name_type", "size_type", "price_type"), dict(found.dtypes).values())}
    return found.agg(F.count("*").alias("n"), F.sum("p_size").alias("sizes")).withColumns(types)


@query("sql_over_view", "select distinct p_brand, p_type from part where p_size > 10")
def _sql_over_view(spark, d):
    parts = table(spark, d, "part")
    return spark.sql("SELECT DISTINCT p_brand, p_type FROM {parts} WHERE p_size > 10", parts=parts)


@query(
    "sql_group_then_filter",
    "select count(*) as n from (select p_partkey, p_type from part group by 1, 2) where p_type > 'M'",
)
def _sql_group_then_filter(spark, d):
    table(spark, d, "part").createOrReplaceTempView("candlemill_grouped_part")
    grouped = spark.sql("SELECT p_partkey, p_type FROM candlemill_grouped_part GROUP BY p_type, p_partkey")
    return grouped.where("p_type > 'M'").agg(F.count("*").alias("n"))


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"raw": [line.encode(CODE_PAGE) for line in batch["line"]]})


def _master_file(spark, d, layout: Layout, values: dict) -> str:
    """Part rows as fixed-width lines in the legacy code page; each tenth line is cut short, each eleventh blank."""
    tail = [F.rpad(values.get(name, F.lit("")), width, " ") for name, width in layout]
    short, standard = HEAD_WIDTHS
    line = F.concat(
        F.rpad(F.lpad(F.col("p_partkey").cast("string"), 7, "0"), short, " "),
        F.rpad(F.lit("KR7"), standard, " "),
        F.rpad(F.concat(F.lit("주식 "), F.col("p_name")), 40, " "),
        *tail,
    )
    key = F.col("p_partkey")
    line = F.when(key % 10 == 0, F.substring(line, 1, 175)).when(key % 11 == 0, "  ").otherwise(line)
    folder = new_folder(spark, "master")
    encoded = table(spark, d, "part").select(line.alias("line")).mapInPandas(_encode, "raw binary")
    encoded.select(F.col("raw").cast("string").alias("value")).write.text(folder)
    return folder


def _main_market(spark, d):
    values = {
        "그룹코드": F.substring("p_type", 1, 2),
        "기준가": F.lpad(F.floor("p_retailprice").cast("string"), 9, "0"),
        "매매수량단위": F.col("p_size").cast("string"),
        "대주가능": F.lit("Y"),
    }
    return read_main_market(spark, _master_file(spark, d, MAIN_MARKET, values))


@query(
    "master_fixed_width",
    """select lpad(cast(p_partkey as varchar), 7, '0') as short_code, '주식 ' || p_name as name,
              substr(p_type, 1, 2) as group_code, p_size as lot, cast(floor(p_retailprice) as bigint) as base_price,
              'Y' as last_flag from part where p_partkey % 10 <> 0 and p_partkey % 11 <> 0""",
)
def _master_fixed_width(spark, d):
    return _main_market(spark, d)[0].select(
        F.col("단축코드").alias("short_code"),
        F.col("한글명").alias("name"),
        F.col("그룹코드").alias("group_code"),
        F.col("매매수량단위").cast("int").alias("lot"),
        F.col("기준가").cast("long").alias("base_price"),
        F.col("대주가능").alias("last_flag"),
    )


@query(
    "master_short_lines",
    """select lpad(cast(p_partkey as varchar), 7, '0') as short_code,
              'line of 175 characters, 248 or more expected' as error from part where p_partkey % 10 = 0""",
)
def _master_short_lines(spark, d):
    errors = _main_market(spark, d)[1]
    return errors.select(F.substring("line", 1, 7).alias("short_code"), "error")


@query(
    "master_second_market",
    """select lpad(cast(p_partkey as varchar), 7, '0') as short_code, '주식 ' || p_name as name,
              substr(p_type, 1, 2) as group_code, p_size as lot, p_brand as sector
       from part where p_partkey % 10 <> 0 and p_partkey % 11 <> 0""",
)
def _master_second_market(spark, d):
    values = {
        "증권그룹구분코드": F.substring("p_type", 1, 2),
        "정규 시장 매매 수량 단위": F.col("p_size").cast("string"),
        "전일 거래량": F.col("p_brand"),
    }
    rows, _ = read_second_market(spark, _master_file(spark, d, SECOND_MARKET, values))
    return rows.select(
        F.col("단축코드").alias("short_code"),
        F.col("한글종목명").alias("name"),
        F.col("증권그룹구분코드").alias("group_code"),
        F.col("정규 시장 매매 수량 단위").cast("int").alias("lot"),
        F.col("전일 거래량").alias("sector"),
    )


@query(
    "expired_files",
    "select distinct cast(ts as date) as landed from events where cast(ts as date) < date '2024-02-10' - 30",
)
def _expired_files(spark, d):
    folder = new_folder(spark, "landed")
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    events.repartition("day").write.partitionBy("day").json(folder)
    cutoff = F.date_sub(F.lit("2024-02-10").cast("date"), 30)
    return expired_files(spark, folder, cutoff).select("landed").distinct()


def _layout(df):
    """Partitions that have rows, and all rows."""
    return partition_sizes(df).agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows"))


@query("layout_repartition", "select 12 as partitions, count(*) as rows from lineitem")
def _layout_repartition(spark, d):
    """Rows dealt in turn to twelve partitions."""
    return _layout(table(spark, d, "lineitem").select("l_orderkey").repartition(12)).select(F.col("partitions").cast("int"), "rows")


@query("layout_coalesce", "select 5 as partitions, count(*) as rows from lineitem")
def _layout_coalesce(spark, d):
    """The same partitions joined to five, without another shuffle."""
    dealt = table(spark, d, "lineitem").select("l_orderkey").repartition(12)
    return _layout(dealt.coalesce(5)).select(F.col("partitions").cast("int"), "rows")


@query(
    "layout_by_key",
    "select l_suppkey, 1 as partitions, count(*) as rows from lineitem group by 1",
)
def _layout_by_key(spark, d):
    """After a repartition by key, all rows of a key are in one partition."""
    dealt = table(spark, d, "lineitem").select("l_suppkey").repartition(12, "l_suppkey")
    of_keys = dealt.groupBy("l_suppkey", F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
    return of_keys.groupBy("l_suppkey").agg(F.count("*").cast("int").alias("partitions"), F.sum("rows").alias("rows"))
