"""Projections, filters, schema inspection."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill.operators.profile import schema_frame
from candlemill.plans.ingest import arrays_to_rows, without_overlap
from candlemill.plans.listing import ordinary_shares, split_pending
from candlemill.registry.base import query, table


@query(
    "proj_select",
    "select c_custkey as code, c_name as name, c_acctbal as balance from customer",
)
def _proj_select(spark, d):
    names = {"c_custkey": "code", "c_name": "name", "c_acctbal": "balance"}
    return table(spark, d, "customer").select(*names).withColumnsRenamed(names)


@query("proj_select_expr", "select p_partkey, upper(p_name) as upper_name, p_retailprice * p_size as total from part")
def _proj_select_expr(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", "upper(p_name) AS upper_name", "p_retailprice * p_size AS total")


@query(
    "proj_with_drop",
    "select o_orderkey, o_custkey, o_totalprice, o_totalprice * cast(1.1 as double) as gross from orders",
)
def _proj_with_drop(spark, d):
    orders = table(spark, d, "orders").withColumn("gross", F.col("o_totalprice") * F.lit(1.1))
    return orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority", "no_such_column")


@query("proj_literal", "select event_id, 'KR' as country, timestamp '2024-02-01 00:00:00' as loaded_at from events")
def _proj_literal(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        F.lit("KR").alias("country"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


@query("filter_predicates", "select event_id from events where event_type <> 'error' and value > 50")
def _filter_predicates(spark, d):
    return table(spark, d, "events").where("event_type != 'error'").filter(F.col("value") > 50).select("event_id")


@query("filter_contains", "select p_partkey, p_name from part where contains(p_name, 'ring')")
def _filter_contains(spark, d):
    return table(spark, d, "part").where(F.contains("p_name", F.lit("ring"))).select("p_partkey", "p_name")


@query(
    "filter_tolerant_number",
    "select page_id, try_cast(regexp_extract(url, '([0-9]+)$', 1) as bigint) as tail from pages",
)
def _filter_tolerant_number(spark, d):
    tail = F.regexp_extract("url", "([0-9]+)$", 1).try_cast("bigint")
    return table(spark, d, "pages").select("page_id", tail.alias("tail"))


@query("listing_filter", "select p_partkey from part where length(p_brand) = 8 and p_type = 'SMALL' and p_size >= 25")
def _listing_filter(spark, d):
    listing = table(spark, d, "part").withColumn("share_class", F.when(F.col("p_size") >= 25, "0").otherwise("1"))
    return ordinary_shares(
        listing, code="p_brand", share_class="share_class", group="p_type", length=8, wanted_group="SMALL"
    ).select("p_partkey")


@query(
    "listing_split",
    """select o_orderkey, o_orderpriority = '5-LOW' and o_orderkey % 3 <> 0 as unchanged from orders
       where o_orderstatus is null or o_orderstatus = 'P'""",
)
def _listing_split(spark, d):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    change = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    listing = table(spark, d, "orders").withColumns({"status": status, "change": change})
    same, changed = split_pending(listing, "status", "change", "5-LOW")
    return same.select("o_orderkey", F.lit(True).alias("unchanged")).unionByName(
        changed.select("o_orderkey", F.lit(False).alias("unchanged"))
    )


WORDS = """select conv_id, turn, string_split(text, ' ') as words from conversations"""


@query(
    "arrays_to_rows",
    f"""select conv_id, turn, unnest(words) as word,
               unnest(list_transform(words, lambda x: cast(length(x) as bigint))) as chars from ({WORDS})""",
)
def _arrays_to_rows(spark, d):
    words = F.split("text", " ")
    chars = F.transform(words, lambda w: F.length(w).cast("long"))
    arrays = table(spark, d, "conversations").select("conv_id", "turn", words.alias("word"), chars.alias("chars"))
    return arrays_to_rows(arrays, ["word", "chars"])


@query(
    "overlap_trim",
    f"select conv_id, turn, array_to_string(words[1:len(words) - 1], ' ') as words from ({WORDS})",
)
def _overlap_trim(spark, d):
    arrays = table(spark, d, "conversations").select("conv_id", "turn", F.split("text", " ").alias("words"))
    trimmed = without_overlap(arrays, ["words"])
    return trimmed.select("conv_id", "turn", F.array_join("words", " ").alias("words"))


@query(
    "schema_frame",
    """select 'o_orderkey' as name, 'bigint' as type, count(o_orderkey) as known from orders
       union all select 'o_custkey', 'bigint', count(o_custkey) from orders
       union all select 'o_orderstatus', 'string', count(o_orderstatus) from orders
       union all select 'o_totalprice', 'double', count(o_totalprice) from orders
       union all select 'o_orderdate', 'timestamp_ntz', count(o_orderdate) from orders
       union all select 'o_orderpriority', 'string', count(o_orderpriority) from orders""",
)
def _schema_frame(spark, d):
    return schema_frame(table(spark, d, "orders")).select("name", "type", "known")


@query(
    "drop_empty_records",
    """select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id
       where quality is not null or toxic is not null""",
)
def _drop_empty_records(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.na.drop(how="all", subset=["quality", "toxic"])
