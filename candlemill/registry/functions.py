"""Scalar functions and user functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from candlemill.functions import clean_event_time, compact_date, last_segment, parse_compact_date, years_before
from candlemill.plans.ingest import cut_windows
from candlemill.registry.base import query, table


@query("str_upper", "select p_partkey, upper(p_name) as name from part")
def _str_upper(spark, d):
    return table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query(
    "str_split_limit",
    """select p_partkey, case when strpos(p_name, ' ') > 0 then substr(p_name, 1, strpos(p_name, ' ') - 1)
              else p_name end as head,
              case when strpos(p_name, ' ') > 0 then substr(p_name, strpos(p_name, ' ') + 1) end as rest from part""",
)
def _str_split_limit(spark, d):
    parts = F.split("p_name", "[ ]", 2)
    return table(spark, d, "part").select("p_partkey", F.get(parts, 0).alias("head"), F.get(parts, 1).alias("rest"))


@query(
    "str_split_all",
    "select doc_id, cast(len(string_split(text, '.')) as bigint) as sentences from documents",
)
def _str_split_all(spark, d):
    pieces = F.size(F.split("text", "[.]", -1)).cast("long")
    return table(spark, d, "documents").select("doc_id", pieces.alias("sentences"))


@query(
    "arr_get",
    "select p_partkey, string_split(p_name, ' ')[2] as second, string_split(p_name, ' ')[6] as sixth from part",
)
def _arr_get(spark, d):
    words = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", F.get(words, 1).alias("second"), F.get(words, 5).alias("sixth"))


@query("arr_explode", "select p_partkey, unnest(string_split(p_name, ' ')) as word from part")
def _arr_explode(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("str_last_segment", "select page_id, string_split(url, '/')[-1] as tail from pages")
def _str_last_segment(spark, d):
    return table(spark, d, "pages").select("page_id", last_segment(F.col("url")).alias("tail"))


@query(
    "time_clean_parse",
    "select event_id, date_trunc('second', ts) as created_at from events",
)
def _time_clean_parse(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parsed = clean_event_time(text).cast("timestamp_ntz")
    return table(spark, d, "events").select("event_id", parsed.alias("created_at"))


@query(
    "date_parse_format",
    """select o_orderkey, strftime(o_orderdate, '%Y%m%d') as text_day,
              cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') as date) as day from orders""",
)
def _date_parse_format(spark, d):
    text = compact_date(F.col("o_orderdate"))
    return table(spark, d, "orders").select(
        "o_orderkey", text.alias("text_day"), parse_compact_date(text).alias("day")
    )


@query(
    "date_arith",
    """select o_orderkey, cast(o_orderdate as date) + 1 as next_day, cast(o_orderdate as date) - 1 as previous_day,
              cast(cast(o_orderdate as date) - interval 120 month as date) as cutoff from orders""",
)
def _date_arith(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 1).alias("previous_day"),
        years_before(day, 10).alias("cutoff"),
    )


ORDER_SPANS = """
    select o_custkey as k, min(cast(o_orderdate as date)) as b, max(cast(o_orderdate as date)) as e
    from orders group by 1
"""


def _windows_sql(last: str, condition: str) -> str:
    return f"""
        select k, f as "from", least(f + 29, e) as "to" from (
            select k, e, cast(unnest(generate_series(cast(b as timestamp), cast({last} as timestamp),
                                                     interval 30 day)) as date) as f
            from ({ORDER_SPANS}) where {condition})
    """


def _order_spans(spark, d):
    day = F.to_date("o_orderdate")
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"))
    return orders.agg(F.min(day).alias("b"), F.max(day).alias("e"))


@query("date_windows", _windows_sql("e", "b <= e"))
def _date_windows(spark, d):
    return cut_windows(_order_spans(spark, d), "b", F.col("e")).drop("e")


@query("date_windows_legacy", _windows_sql("e - interval 1 day", "b < e"))
def _date_windows_legacy(spark, d):
    return cut_windows(_order_spans(spark, d), "b", F.col("e"), legacy_tail=True).drop("e")


@query("kv_map_values", "select l_orderkey, l_linenumber + 1 as next_line from lineitem")
def _kv_map_values(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") + 1).alias("next_line"))


@query("json_expand", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def _json_expand(spark, d):
    parsed = F.from_json("props", "k bigint").alias("s")
    return table(spark, d, "events").select("event_id", parsed).select("event_id", "s.*")


@query("udf_scalar", "select upper(p_type) as kind, count(*) as n from part group by 1")
def _udf_scalar(spark, d):
    upper = F.udf(lambda v: None if v is None else v.upper(), "string", useArrow=True)
    return table(spark, d, "part").groupBy(upper("p_type").alias("kind")).agg(F.count("*").alias("n"))


def _shout(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "lang": batch["lang"].str.upper(),
                "words": batch["text"].str.count(" ") + 1,
            }
        )


def _with_index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    index = TaskContext.get().partitionId()
    for batch in batches:
        yield batch.assign(index=index)


@query(
    "map_partitions_with_index",
    "select lang, count(*) as n, cast(1 as bigint) as partitions, true as within from documents group by 1",
)
def _map_partitions_with_index(spark, d):
    """Rows dealt by language carry the number of their partition: one for each language."""
    documents = table(spark, d, "documents").select("lang").repartition(5, "lang")
    indexed = documents.mapInPandas(_with_index, "lang string, index int")
    return indexed.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count_distinct("index").alias("partitions"),
        F.every(F.col("index").between(0, 4)).alias("within"),
    )


@query(
    "map_partitions",
    "select doc_id, upper(lang) as lang, cast(len(string_split(text, ' ')) as bigint) as words from documents",
)
def _map_partitions(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang", "text")
    return documents.mapInPandas(_shout, "doc_id bigint, lang string, words bigint")
