"""Planning, fetching, rebase detection, deletes, listing, consolidation."""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.keyed import until_second_empty
from candlemill.plans.consolidate import codes_to_move, consolidate_into, consolidated
from candlemill.plans.daily import daily_update
from candlemill.plans.ingest import (
    WINDOW_DAYS,
    cut_windows,
    new_prices,
    plan_windows,
    purge_delisted,
    purge_old,
    purge_range,
    rebased_codes,
    rows_after_stored,
    without_rebased,
)
from candlemill.plans.listing import fresh_snapshot, mark_done, save_snapshot
from candlemill.plans.store import STEPS, PriceStore
from candlemill.registry.base import DAILY_SERIES, daily_series, query, table
from candlemill.sinks.tables import KeyedTable
from candlemill.sources.fetch import fetch_windows, walk_windows
from candlemill.sources.files import read_json
from candlemill.sources.footers import footer_aggregates, high_water_mark
from candlemill.workspace import new_folder, new_table, written

AS_OF = datetime.date(2002, 1, 1)
LISTED = datetime.date(1995, 6, 1)


@query(
    "plan_windows",
    f"""select code, f as "from", least(f + 29, date '{AS_OF}') as "to" from (
            select code, l, cast(unnest(generate_series(cast(b as timestamp), timestamp '{AS_OF}',
                                                        interval 30 day)) as date) as f
            from (select c_custkey as code, max(cast(o_orderdate as date)) as l,
                         coalesce(max(cast(o_orderdate as date)),
                                  greatest(date '{LISTED}', cast(date '{AS_OF}' - interval 120 month as date))) as b
                  from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'F' group by 1)
            where b <= date '{AS_OF}')
        where l is null or least(f + 29, date '{AS_OF}') <> l""",
)
def _plan_windows(spark, d):
    listing = table(spark, d, "customer").select(F.col("c_custkey").alias("code"), F.lit(LISTED).alias("listed_day"))
    stored = table(spark, d, "orders").where("o_orderstatus = 'F'")
    prices = stored.select(F.col("o_custkey").alias("code"), F.to_date("o_orderdate").alias("day"))
    return plan_windows(listing, prices, AS_OF)


WINDOWS_OF_CODES = f"""
    with s as ({DAILY_SERIES}),
         w as (select code, f, least(f + {WINDOW_DAYS - 1}, e) as t from (
                 select code, e, cast(unnest(generate_series(cast(b as timestamp), cast(e as timestamp),
                                                             interval {WINDOW_DAYS} day)) as date) as f
                 from (select code, min(day) as b, max(day) as e from s group by 1)))
"""

PRICE_SERIES = T.StructType(
    [
        T.StructField("code", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("close", T.LongType()),
        T.StructField("volume", T.LongType()),
    ]
)
PRICES = T.StructType(
    [
        T.StructField("code", T.LongType()),
        T.StructField("day", T.StringType()),
        T.StructField("close", T.LongType()),
        T.StructField("volume", T.LongType()),
    ]
)


def _answer(request: Mapping) -> dict[str, list]:
    """Stands in for a service: the request row carries the text it would answer with."""
    if request["answer"] is None:
        raise LookupError("nothing in this window")
    days = json.loads(request["answer"])
    lists = {name: [day[name] for day in days] for name in ("day", "close", "volume")}
    return {"code": [request["code"]] * len(days), **lists}


def _requests(spark, d):
    """A request for each window of each code, from its first to its last day."""
    series = daily_series(spark, d)
    spans = series.groupBy("code").agg(F.min("day").alias("b"), F.max("day").alias("e"))
    windows = cut_windows(spans, "b", F.col("e")).drop("e")
    # The rows of a window: as many as it has days.
    start = F.expr(f"date_add(b, cast((datediff(day, b) div {WINDOW_DAYS}) * {WINDOW_DAYS} as int))")
    answers = (
        series.join(spans, "code")
        .groupBy("code", start.alias("from"))
        .agg(F.collect_list(F.struct(F.col("day").cast("string").alias("day"), "close", "volume")).alias("days"))
        .select("code", "from", F.to_json("days").alias("answer"))
    )
    return windows.join(answers, ["code", "from"], "left").select(
        "code", F.col("from").cast("string").alias("from"), F.col("to").cast("string").alias("to"), "answer"
    )


def _fetched(spark, d):
    return fetch_windows(_requests(spark, d), _answer, PRICES, pause=0.0, parallelism=8)


@query("fetch_partitions", f"select * from ({DAILY_SERIES})")
def _fetch_partitions(spark, d):
    rows, _ = _fetched(spark, d)
    return rows.withColumn("day", F.to_date("day"))


@query(
    "fetch_errors",
    f"""{WINDOWS_OF_CODES} select code, f as "from", t as "to", 'LookupError: nothing in this window' as error
        from w where not exists (select 1 from s where s.code = w.code and s.day between w.f and w.t)""",
)
def _fetch_errors(spark, d):
    _, errors = _fetched(spark, d)
    return errors.select("code", F.to_date("from").alias("from"), F.to_date("to").alias("to"), "error")


@query(
    "windows_until_empty",
    """select user_id, m, n from (
           select user_id, m, n, sum(case when n = 0 then 1 else 0 end) over (
                      partition by user_id order by m desc rows unbounded preceding) as e
           from (select g.user_id, g.m, count(v.event_id) as n
                 from (select user_id, cast(unnest(generate_series(1, 31)) as integer) as m
                       from (select distinct user_id from events)) g
                 left join events v on v.user_id = g.user_id and day(v.ts) = g.m group by 1, 2))
       where e <= 1 and n > 0""",
)
def _windows_until_empty(spark, d):
    events = table(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("m"))
    found = events.groupBy("user_id", "m").agg(F.count("*").alias("n"))
    grid = events.select("user_id").distinct()
    grid = grid.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("m"))
    windows = grid.join(found, ["user_id", "m"], "left").na.fill(0, ["n"])
    return until_second_empty(windows, ["user_id"], "m", "n")


# Windows of a code, newest first, with the empty ones before each.
WALKED = f"""{WINDOWS_OF_CODES},
    filled as (select w.code, f, t, count(s.day) as n from w left join s on s.code = w.code and s.day between f and t group by 1, 2, 3),
    walked as (select *, coalesce(sum(case when n = 0 then 1 else 0 end) over (
                   partition by code order by f desc rows between unbounded preceding and 1 preceding), 0) as empties from filled)
"""


def _empty_or_days(request: Mapping) -> dict[str, list]:
    """The stand-in service again, which here answers an empty window with no rows."""
    return _answer({**request, "answer": request["answer"] or "[]"})


def _walked(spark, d):
    return walk_windows(_requests(spark, d), _empty_or_days, PRICES, "code", "from", pause=0.0, parallelism=8)


@query("walk_rows", f"{WALKED} select s.* from s join walked w on w.code = s.code and s.day between f and t where empties <= 1")
def _walk_rows(spark, d):
    rows, _, _ = _walked(spark, d)
    return rows.withColumn("day", F.to_date("day"))


@query("walk_calls", f"{WALKED} select code, count(*) as calls from walked where empties <= 1 group by 1")
def _walk_calls(spark, d):
    """Calls of each code: none beyond its second empty window."""
    return _walked(spark, d)[2]


REBASED = "select s_suppkey from supplier where s_acctbal > 5000"

# The service's answer in the daily run: every day, rebased codes at twice the price.
SERVED = f"""
    select code, day, case when code in ({REBASED}) then close * 2 else close end as close, volume
    from ({DAILY_SERIES})
"""


def _served(spark, d):
    doubled = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("code"))
    series = daily_series(spark, d).join(doubled.withColumn("_x", F.lit(2)), "code", "left")
    return series.withColumn("close", F.col("close") * F.coalesce("_x", F.lit(1))).drop("_x")


def _answers(served, asked):
    """The served rows of the ``asked`` windows, matched by blocks of days.

    A window is in one or two blocks, so days are never spelled out.  Windows take so little room in a file that Spark
    would broadcast millions of them from its estimate; hence the hint.
    """
    blocks = [F.expr(f"unix_date(`{name}`) div {WINDOW_DAYS}") for name in ("from", "to")]
    spans = asked.select(F.col("code").alias("_code"), "from", "to", F.explode(F.sequence(*blocks)).alias("_block"))
    block = F.expr(f"unix_date(day) div {WINDOW_DAYS}")
    inside = (F.col("code") == F.col("_code")) & (block == F.col("_block")) & F.col("day").between(F.col("from"), F.col("to"))
    return served.join(spans.hint("merge"), inside, "left_semi")


# Codes whose listing announces a new price basis; some of them did change.
ANNOUNCED = "s_suppkey % 7 = 0"


def _daily_run(spark, d, listing, stored, failing="false"):
    """A run against a table-backed service; requests that match ``failing`` get no answer."""
    served = _served(spark, d)

    def fetch(requests):
        asked = written(requests, "asked")
        return written(_answers(served, asked.where(f"not ({failing})")), "answered"), asked.where(failing)

    return daily_update(listing, stored, fetch, AS_OF)


def _first_listing(spark, d):
    announced = table(spark, d, "supplier").where(ANNOUNCED).select(F.col("s_suppkey").alias("code"), F.lit("02").alias("c"))
    listing = daily_series(spark, d).groupBy("code").agg(F.min("day").alias("listed_day")).join(announced, "code", "left")
    return listing.select("code", "listed_day", F.coalesce("c", F.lit("00")).alias("price_change"), F.lit("").alias("etlcheck"))


def _half_stored(spark, d):
    return daily_series(spark, d).where("day <= date '1999-12-31'")


@query("daily_prices", SERVED)
def _daily_prices(spark, d):
    """Half the history is stored; the rest, and rebased codes, are fetched without failures."""
    update = _daily_run(spark, d, _first_listing(spark, d), _half_stored(spark, d))
    return update.kept.unionByName(update.added)


LISTING = f"""
    select code, min(day) as listed_day, case when code in (select s_suppkey from supplier where {ANNOUNCED})
           then '02' else '00' end as price_change from ({DAILY_SERIES}) group by 1
"""


@query("daily_listing", f"select *, '{AS_OF:%Y%m%d}' as etlcheck from ({LISTING})")
def _daily_listing(spark, d):
    return _daily_run(spark, d, _first_listing(spark, d), _half_stored(spark, d)).listing


# Requests that fail in the first of two runs: some windows of every second code.
FAILING = "code % 2 = 0 and (datediff(`from`, date '1970-01-01') div 30 + code) % 9 = 0"


def _two_runs(spark, d):
    first = _daily_run(spark, d, _first_listing(spark, d), _half_stored(spark, d), FAILING)
    stored = written(first.kept.unionByName(first.added), "stored")
    return _daily_run(spark, d, written(first.listing, "listing"), stored)


@query("daily_retry_prices", SERVED)
def _daily_retry_prices(spark, d):
    """Requests failed in the first run; the second one leaves no hole."""
    update = _two_runs(spark, d)
    return update.kept.unionByName(update.added)


@query("daily_retry_listing", f"select *, '{AS_OF:%Y%m%d}' as etlcheck from ({LISTING})")
def _daily_retry_listing(spark, d):
    return _two_runs(spark, d).listing


STORED_PRICES = "code bigint, day date, close bigint, volume bigint"


def _stored_run(spark, d):
    """A run that stops after each of its steps, and goes on as often."""
    store = PriceStore(spark, new_folder(spark, "store"), STORED_PRICES, spans=(5, 20), buckets=8)
    store.load(written(_half_stored(spark, d), "first"))
    served = _served(spark, d)

    def fetch(requests):
        return written(_answers(served, written(requests, "asked")), "answered"), requests.limit(0)

    def no_fetch(requests):
        raise RuntimeError("a resumed run fetches nothing again")

    for step in STEPS:
        store.daily("run", _first_listing(spark, d), fetch if step == STEPS[0] else no_fetch, AS_OF, stop_after=step)
    return store


@query("stored_run_prices", SERVED)
def _stored_run_prices(spark, d):
    return _stored_run(spark, d).read("prices")


def _stored_mean(value: str) -> str:
    weight = "pow(1 - 2.0 / 21, t.rn - s.rn)"
    return f"round(sum(s.{value} * {weight}) / sum({weight}) + 1e-7, 3)"


@query(
    "stored_run_indicators",
    f"""with r as (select *, row_number() over (partition by code order by day) as rn from ({SERVED}))
        select t.code, t.day, {_stored_mean("close")} as close_20, {_stored_mean("volume")} as volume_20
        from r t join r s on s.code = t.code and s.rn <= t.rn group by 1, 2""",
)
def _stored_run_indicators(spark, d):
    stored = _stored_run(spark, d).read("indicators")
    return stored.select("code", "day", *[F.round(F.col(f"eavg_{v}_20") + 1e-7, 3).alias(f"{v}_20") for v in ("close", "volume")])


def _rebased(spark, d):
    stored = daily_series(spark, d)
    return stored, rebased_codes(_served(spark, d), stored, "code", "day", "close")


@query("detect_rebased", f"select distinct code from ({DAILY_SERIES}) where close > 0 and code in ({REBASED})")
def _detect_rebased(spark, d):
    return _rebased(spark, d)[1]


@query("drop_rebased", f"select * from ({DAILY_SERIES}) where code not in ({REBASED})")
def _drop_rebased(spark, d):
    stored, rebased = _rebased(spark, d)
    return without_rebased(stored, rebased, "code")


@query(
    "delete_range",
    """select o_orderkey from orders o
       join (select o_custkey as k, min(cast(o_orderdate as date)) as b from orders group by 1) r on o.o_custkey = r.k
       where not (cast(o_orderdate as date) between b + 100 and b + 900)""",
)
def _delete_range(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    first = orders.groupBy("o_custkey").agg(F.min("day").alias("b"))
    # Overlapping and touching ranges that together make days 100 to 900.
    offsets = ((100, 500), (300, 899), (900, 900))
    spans = [F.struct(F.date_add("b", a).alias("from"), F.date_add("b", z).alias("to")) for a, z in offsets]
    ranges = first.select("o_custkey", F.inline(F.array(*spans)))
    return purge_range(orders, ranges, "o_custkey", "day").select("o_orderkey")


@query("purge_retention", "select o_orderkey from orders where o_orderdate >= timestamp '1998-01-01'")
def _purge_retention(spark, d):
    return purge_old(table(spark, d, "orders"), "o_orderdate", datetime.date(2008, 1, 1)).select("o_orderkey")


@query(
    "purge_delisted",
    """select o_orderkey, o_custkey from orders
       where o_custkey in (select c_custkey from customer where c_mktsegment <> 'MACHINERY')""",
)
def _purge_delisted(spark, d):
    listing = table(spark, d, "customer").where("c_mktsegment <> 'MACHINERY'")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return purge_delisted(orders, listing.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query(
    "append_new_prices",
    f"""select * from ({DAILY_SERIES}) where day > date '1999-12-31'""",
)
def _append_new_prices(spark, d):
    series = daily_series(spark, d)
    return new_prices(series.where("day <= date '1999-12-31'"), series.unionByName(series))


@query("insert_absent_bucketed", DAILY_SERIES)
def _insert_absent_bucketed(spark, d):
    """Batches that overlap, all days of each, go into a table bucketed and sorted by (code, day)."""
    stored = KeyedTable(spark, new_table("prices"), new_folder(spark, "prices"), ("code", "day"), buckets=64)
    series = written(daily_series(spark, d), "series")
    for batch in ("code % 3 = 0", "code % 2 = 0", "true", "true"):
        stored.insert(series.where(batch))
    return stored.rows()


@query("footer_bounds", f"select max(day) as mark, min(code) as first_code, count(*) as n from ({DAILY_SERIES})")
def _footer_bounds(spark, d):
    """The high-water mark and the row count of a stored table, from its footers."""
    path = new_folder(spark, "series")
    daily_series(spark, d).write.parquet(path)
    return footer_aggregates(spark, path, {"mark": ("max", "day"), "first_code": ("min", "code"), "n": ("count", "*")})


@query(
    "footer_bounds_by_part",
    f"select cast(code % 8 as bigint) as part, max(day) as mark, count(*) as n from ({DAILY_SERIES}) group by 1",
)
def _footer_bounds_by_part(spark, d):
    path = new_folder(spark, "series")
    daily_series(spark, d).withColumn("part", F.col("code") % 8).write.partitionBy("part").parquet(path)
    shape = T.StructType([*PRICE_SERIES, T.StructField("part", T.LongType())])
    return footer_aggregates(spark, path, {"mark": ("max", "day"), "n": ("count", "*")}, by=["part"], schema=shape)


@query("append_above_mark", f"select * from ({DAILY_SERIES})")
def _append_above_mark(spark, d):
    """An increment: what is later than the stored table's mark, which only footers are read for."""
    path = new_folder(spark, "series")
    series = daily_series(spark, d)
    series.where("day <= date '2000-06-30'").write.parquet(path)
    mark = high_water_mark(spark, path, "day")
    series.where(F.col("day") > F.lit(mark)).write.mode("append").parquet(path)
    return spark.read.schema(PRICE_SERIES).parquet(path)


@query(
    "rows_after_stored",
    f"""with s as ({DAILY_SERIES}),
            m as (select code, max(day) as last_day from s where volume > 25 group by 1)
        select s.* from s left join m on s.code = m.code where last_day is null or day > last_day""",
)
def _rows_after_stored(spark, d):
    series = daily_series(spark, d)
    return rows_after_stored(series, series.where("volume > 25"), "code", "day")


@query(
    "mark_etl_done",
    """select c_custkey, case when k is not null then '20240101' else '' end as etlcheck
       from customer left join (select distinct o_custkey k from orders where o_orderstatus = 'F') on c_custkey = k""",
)
def _mark_etl_done(spark, d):
    listing = table(spark, d, "customer").select("c_custkey", F.lit("").alias("etlcheck"))
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return mark_done(listing, done, "c_custkey", F.lit("20240101"))


def _snapshot_query(name: str, as_of: str, check: str):
    @query(name, f"select p_partkey, p_name, '{as_of}' as etldate, {check} as etlcheck from part")
    def snapshot(spark, d):
        source = table(spark, d, "part").select("p_partkey", "p_name")
        taken = source.withColumns({"etldate": F.lit("20240101"), "etlcheck": F.lit("20240101")})
        return fresh_snapshot(written(taken, "listing"), source, as_of)


_snapshot_query("listing_snapshot_fresh", "20240101", "'20240101'")
_snapshot_query("listing_snapshot_stale", "20240102", "cast(null as varchar)")


@query(
    "listing_snapshot_json",
    "select p_partkey, p_name, '20240103' as etldate, cast(null as varchar) as etlcheck from part",
)
def _listing_snapshot_json(spark, d):
    """The snapshot as JSON: yesterday's is read, replaced by today's and read back."""
    folder = new_folder(spark, "listing")
    source = table(spark, d, "part").select("p_partkey", "p_name")
    source.withColumns({"etldate": F.lit("20240102"), "etlcheck": F.lit("20240102")}).write.json(folder)
    shape = "p_partkey bigint, p_name string, etldate string, etlcheck string"
    save_snapshot(fresh_snapshot(read_json(spark, folder, shape)[0], source, "20240103"), folder)
    return read_json(spark, folder, shape)[0]


# Codes as a listing may have them; paths encode the blank, the plus sign and the letters.
CODES = {"F": "005930", "O": "가나 B+", "P": "P"}


def _per_code_tables(spark, d) -> str:
    """A folder of part files for each code (tests have plain files too)."""
    root = new_folder(spark, "per-code")
    orders = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus")
    for status, code in CODES.items():
        orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus").write.parquet(f"{root}/{code}.parquet")
    return root


SHAPE = "day date, o_orderpriority string"
ORDER_DAYS = f"""
    select distinct cast(o_orderdate as date) as day, o_orderpriority,
           case o_orderstatus when 'F' then '{CODES["F"]}' when 'O' then '{CODES["O"]}' else 'P' end as code from orders
"""


@query("consolidate_tables", ORDER_DAYS)
def _consolidate_tables(spark, d):
    return consolidated(spark, _per_code_tables(spark, d), SHAPE)


def _order_codes(spark, d):
    code = F.when(F.col("o_orderstatus") == "F", CODES["F"]).when(F.col("o_orderstatus") == "O", CODES["O"])
    return table(spark, d, "orders").select(code.otherwise("P").alias("code"))


@query("consolidate_missing", f"select * from ({ORDER_DAYS}) where code <> 'P'")
def _consolidate_missing(spark, d):
    old = _order_codes(spark, d)
    # One code per table to open: the driver lists the paths of a scan anyway.
    missing = [row["code"] for row in codes_to_move(old, old, old.where("code = 'P'"), "code").collect()]
    return consolidated(spark, _per_code_tables(spark, d), SHAPE, missing)


@query("consolidate_insert", ORDER_DAYS)
def _consolidate_insert(spark, d):
    """Two runs into one table: the first creates it, the second finds one code missing."""
    root, path = _per_code_tables(spark, d), new_folder(spark, "consolidated")
    name = new_table("consolidated")
    consolidate_into(spark, name, path, root, SHAPE, [CODES["F"], CODES["O"]])
    return consolidate_into(spark, name, path, root, SHAPE)


@query("consolidate_grown", ORDER_DAYS)
def _consolidate_grown(spark, d):
    """The per-code tables gain days between two runs: the second inserts just these."""
    root, name, path = new_folder(spark, "per-code"), new_table("grown"), new_folder(spark, "grown")
    orders = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus")
    for days in ("day < date '1996-01-01'", "day >= date '1995-12-01'"):
        for status, code in CODES.items():
            rows = orders.where((F.col("o_orderstatus") == status) & F.expr(days)).drop("o_orderstatus")
            rows.write.mode("append").parquet(f"{root}/{code}.parquet")
        found = consolidate_into(spark, name, path, root, SHAPE)
    return found
