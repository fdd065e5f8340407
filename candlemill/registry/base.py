"""Registration, table access and the stand-in frames the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.plans.events import BOT

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = " ".join(sql.split())
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price-like series: per supplier and day, whole-number value and quantity."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("code"), F.to_date("l_shipdate").alias("day"))
        .agg(
            F.sum(cents).alias("_cents"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
        .select("code", "day", F.expr("_cents div 100").alias("close"), "volume")
    )


DAILY_SERIES = """
    select l_suppkey as code, cast(l_shipdate as date) as day,
           cast(sum(cast(round(l_extendedprice * 100) as bigint)) // 100 as bigint) as close,
           cast(sum(l_quantity) as bigint) as volume
    from lineitem group by 1, 2
"""

# The table has five event types; with the parity of the event there are ten, so each kind has its own.
KINDS = {
    "push": "view_0",
    "pr": "click_0",
    "fork": "purchase_0",
    "issue": "signup_0",
    "issue_comment": "error_0",
    "watch": "error_1",
    "release": "purchase_1",
}


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested activity records derived from the event table; one user plays the bot."""
    user = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("long")
    repo = F.concat(F.lit("org"), (F.col("user_id") % 10).cast("string"), F.lit("/repo"), k.cast("string"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.concat_ws("_", "event_type", (F.col("event_id") % 2).cast("string")).alias("type"),
        F.lit(True).alias("public"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(
            F.when(F.col("user_id") == 0, BOT).otherwise(F.concat(F.lit("u"), user)).alias("login"),
            F.concat(F.lit("https://users.example/"), user).alias("url"),
        ).alias("actor"),
        F.struct(repo.alias("name"), F.concat(F.lit("https://repos.example/"), repo).alias("url")).alias("repo"),
        F.lit(None).cast("string").alias("org"),
        F.struct(
            k.alias("repository_id"),
            F.floor("value").alias("size"),
            F.floor(F.col("value") / 2).alias("distinct_size"),
            F.struct(F.col("props").alias("body")).alias("comment"),
        ).alias("payload"),
    )


RAW_EVENTS = f"""
    select cast(event_id as varchar) as id, event_type || '_' || (event_id % 2) as type, date_trunc('second', ts) as created_at,
           case when user_id = 0 then '{BOT}' else 'u' || user_id end as login,
           'https://users.example/' || user_id as url,
           'org' || (user_id % 10) || '/repo' || json_extract_string(props, '$.k') as repo_path,
           cast(json_extract(props, '$.k') as bigint) as repository_id,
           cast(floor(value) as bigint) as size, cast(floor(value / 2) as bigint) as distinct_size,
           props as body
    from events
"""

REFINED_EVENTS = f"""
    select id, type, created_at, login as user_name, url, 'https://repos.example/' || repo_path as repo_url,
           string_split(repo_path, '/')[-1] as repo_name, repository_id, size, distinct_size, body
    from ({RAW_EVENTS}) where login <> '{BOT}'
"""
