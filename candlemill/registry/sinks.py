"""Appends, replacements and the index sink, each read back."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.plans.events import daily_stats, mart, publish, publish_mart, refined, repo_stats, user_stats
from candlemill.plans.ingest import rows_after_stored
from candlemill.plans.publish import Published
from candlemill.registry.base import DAILY_SERIES, KINDS, REFINED_EVENTS, daily_series, query, raw_events, table
from candlemill.registry.events import DAILY_STATS, REPO_STATS, USER_STATS
from candlemill.sinks.committed import read_committed, write_committed
from candlemill.sinks.index import IndexSink
from candlemill.sinks.tables import append_bucketed, read_bucketed, replace_buckets
from candlemill.workspace import new_folder

SERIES = "code bigint, day date, close bigint, volume bigint"
BUCKETS = 8


@query("sink_parquet_append", f"select * from ({DAILY_SERIES})")
def _sink_parquet_append(spark, d):
    """A first load, then only what is later than the last stored day of each code."""
    path = new_folder(spark, "prices")
    series = daily_series(spark, d)
    append_bucketed(series.where("day <= date '2000-06-30'"), path, ["code"], BUCKETS)
    stored = read_bucketed(spark, path, SERIES)
    append_bucketed(rows_after_stored(series, stored, "code", "day"), path, ["code"], BUCKETS)
    return read_bucketed(spark, path, SERIES)


@query(
    "sink_replace_buckets",
    f"select * from ({DAILY_SERIES}) where code not in (select s_suppkey from supplier where s_acctbal < 0)",
)
def _sink_replace_buckets(spark, d):
    """Purge some codes from a stored table, rewriting only the buckets they are in."""
    path = new_folder(spark, "prices")
    append_bucketed(daily_series(spark, d), path, ["code"], BUCKETS)
    gone = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("code"))
    replace_buckets(spark, path, SERIES, ["code"], gone, lambda rows: rows.join(gone, "code", "left_anti"), BUCKETS)
    return read_bucketed(spark, path, SERIES)


LOADED = "2024-02-01 00:00:00"


def _mart_query(name: str, stats, keys: list[str], sql: str, id_sql: str):
    @query(name, f"select md5({id_sql}) as id, timestamp '{LOADED}' as loaded_at, * from ({sql})")
    def published(spark, d):
        """The mart, read back from the index output."""
        resource = new_folder(spark, "mart")
        counted = stats(refined(raw_events(spark, d)), KINDS)
        sink = IndexSink(hosts="localhost", id_column="id", format="json")
        publish_mart(counted, keys, sink, resource, F.lit(LOADED).cast("timestamp_ntz"))
        shape = [T.StructField("id", T.StringType()), T.StructField("@timestamp", T.TimestampNTZType()), *counted.schema]
        return spark.read.schema(T.StructType(shape)).json(resource).withColumnRenamed("@timestamp", "loaded_at")


_mart_query("mart_repos", repo_stats, ["repo_url"], REPO_STATS, "repo_url")
_mart_query("mart_users", user_stats, ["user_name"], USER_STATS, "user_name")
_mart_query("mart_days", daily_stats, ["day"], DAILY_STATS, "cast(day as varchar)")


@query(
    "sink_index_json",
    f"""select id, user_name, repo_name, timestamp '2024-02-01 00:00:00' as loaded_at from ({REFINED_EVENTS})""",
)
def _sink_index_json(spark, d):
    resource = new_folder(spark, "index")
    events = refined(raw_events(spark, d)).select("id", "user_name", "repo_name")
    sink = IndexSink(hosts="localhost", id_column="id", format="json")
    publish(events, sink, resource, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    stored = spark.read.schema("id string, user_name string, repo_name string, `@timestamp` timestamp_ntz").json(
        resource
    )
    return stored.withColumnRenamed("@timestamp", "loaded_at")


@query("sink_committed", "select o_orderkey, o_custkey, o_totalprice from orders")
def _sink_committed(spark, d):
    """Two batches; a task of the second fails, so nothing of that attempt is seen, and the batch is written again, twice."""
    path = new_folder(spark, "committed")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    later = orders.where("o_orderkey % 2 = 1").repartition(4)

    def failing(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().partitionId() == 2:
            raise OSError("the disk of this task is full")

    write_committed(orders.where("o_orderkey % 2 = 0"), path, "even")
    try:
        write_committed(later.mapInArrow(failing, later.schema), path, "odd")
    except PySparkException:
        write_committed(later, path, "odd")
    write_committed(later, path, "odd")
    return read_committed(spark, path, orders.schema)


@query(
    "sink_foreach_partition",
    "select o_orderstatus, count(*) as n, cast(sum(o_custkey) as bigint) as customers from orders group by 1",
)
def _sink_foreach_partition(spark, d):
    """Each partition is handed to a function that stores it; accumulators tell what was handed over."""
    orders = table(spark, d, "orders")
    seen = {status: (spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)) for status in "FOP"}

    def store(rows):
        for row in rows:
            count, customers = seen[row["o_orderstatus"]]
            count.add(1)
            customers.add(row["o_custkey"])

    orders.select("o_orderstatus", "o_custkey").foreachPartition(store)
    totals = [(status, count.value, customers.value) for status, (count, customers) in seen.items() if count.value]
    return spark.createDataFrame(totals, "o_orderstatus string, n bigint, customers bigint")


# The second publication: events of some repositories are new, those of others were withdrawn.
FIRST_EVENTS, SECOND_EVENTS = "repository_id % 5 <> 1", "repository_id % 5 <> 2"
STATS_BEFORE = REPO_STATS.replace(f"({REFINED_EVENTS})", f"(select * from ({REFINED_EVENTS}) where {FIRST_EVENTS})")
STATS_AFTER = REPO_STATS.replace(f"({REFINED_EVENTS})", f"(select * from ({REFINED_EVENTS}) where {SECOND_EVENTS} or user_name = 'u1')")


@query(
    "publish_changes",
    f"""with b as ({STATS_BEFORE}), a as ({STATS_AFTER})
        select md5(coalesce(a.repo_url, b.repo_url)) as id, a.*,
               case when a.repo_url is null then 'delete' else 'index' end as operation
        from a full join b on a.repo_url = b.repo_url
        where a.repo_url is null or b.repo_url is null
           or (a.commit_count, a.push_count, a.pr_count, a.fork_count, a.issue_count, a.watch_count)
              <> (b.commit_count, b.push_count, b.pr_count, b.fork_count, b.issue_count, b.watch_count)""",
)
def _publish_changes(spark, d):
    """What the second publication sends: changed, new and removed documents only."""
    published = Published(spark, new_folder(spark, "published"))
    sink, events = IndexSink(hosts="localhost", id_column="id", format="json"), refined(raw_events(spark, d))
    for stamp, some in (("2024-02-01 00:00:00", FIRST_EVENTS), ("2024-02-02 00:00:00", f"{SECOND_EVENTS} or user_name = 'u1'")):
        docs = mart(repo_stats(events.where(some), KINDS), ["repo_url"], F.lit(stamp).cast("timestamp_ntz"))
        resource = new_folder(spark, "index")
        sent = published.publish(docs, sink, resource)
    return spark.read.schema(sent.schema).json(resource).drop("@timestamp")
