"""The composite jobs on small hand-made frames."""

import datetime

import pytest
from pyspark.sql import functions as F

from candlemill.plans import consolidate, events, ingest, listing, textstats
from candlemill.sinks.index import AUTO_CREATE, CONNECTOR, ID, NODES, RESOURCE, IndexSink
from candlemill.workspace import new_folder

D = datetime.date.fromisoformat


# ---- planning


def test_plan_starts_where_the_store_ends(spark, rows):
    listed = spark.createDataFrame(
        [("000001", D("2023-12-01")), ("000002", D("2024-01-20")), ("000003", D("1990-01-01")), ("000004", D("2000-01-01"))],
        ["code", "listed_day"],
    )
    prices = spark.createDataFrame(
        [("000001", D("2024-01-01")), ("000001", D("2023-12-31")), ("000004", D("2024-02-01"))], ["code", "day"]
    )
    plan = rows(ingest.plan_windows(listed, prices, D("2024-02-01")))
    assert [r for r in plan if r[0] == "000001"] == [
        ("000001", D("2024-01-01"), D("2024-01-30")),
        ("000001", D("2024-01-31"), D("2024-02-01")),
    ]
    assert [r for r in plan if r[0] == "000002"] == [("000002", D("2024-01-20"), D("2024-02-01"))]
    oldest = [r for r in plan if r[0] == "000003"]
    assert oldest[0][1] == D("2014-02-01") and oldest[-1][2] == D("2024-02-01")
    assert [r for r in plan if r[0] == "000004"] == []


def test_older_rule_starts_the_day_after(spark):
    df = spark.createDataFrame([(D("2024-01-31"),), (None,)], "last date")
    starts = df.select(
        ingest.next_day_start(F.col("last")).alias("a"),
        ingest.next_day_start(F.col("last"), ingest.FIRST_DAY_FILES).alias("b"),
    )
    assert [tuple(r) for r in starts.collect()] == [
        (D("2024-02-01"), D("2024-02-01")),
        (D("2000-01-01"), D("1985-01-01")),
    ]


# ---- rebase, append, purge


def prices(spark, data):
    return spark.createDataFrame(data, "code string, day date, close bigint")


def test_rebase_is_a_different_price_on_the_same_day(spark, rows):
    stored = prices(spark, [("a", D("2024-01-02"), 100), ("b", D("2024-01-02"), 50), ("c", D("2024-01-02"), 9)])
    fetched = prices(spark, [("a", D("2024-01-02"), 20), ("b", D("2024-01-02"), 50), ("c", D("2024-01-03"), 1)])
    rebased = ingest.rebased_codes(fetched, stored, "code", "day", "close")
    assert rows(rebased) == [("a",)]
    assert {r["code"] for r in ingest.without_rebased(stored, rebased, "code").collect()} == {"b", "c"}


def test_responses_become_rows_without_the_overlap(spark, rows):
    responses = spark.createDataFrame(
        [("a", ["20240103", "20240102", "20240101"], [3, 2, 1]), ("b", ["20240101"], [7]), ("c", [], [])],
        "code string, day array<string>, close array<bigint>",
    )
    assert rows(ingest.price_rows(responses, ["day", "close"], "day")) == [("a", "20240102", 2), ("a", "20240103", 3)]


def test_append_twice_adds_once(spark, rows):
    batch = prices(spark, [("a", D("2024-01-02"), 1), ("a", D("2024-01-02"), 1), ("a", D("2024-01-03"), 2)])
    empty = batch.limit(0)
    first = ingest.new_prices(empty, batch)
    assert first.count() == 2
    assert ingest.new_prices(first, batch).count() == 0


def test_purges(spark, rows):
    stored = prices(spark, [("a", D("2014-01-31"), 1), ("a", D("2014-02-01"), 2), ("b", D("2024-01-01"), 3)])
    assert {r["close"] for r in ingest.purge_old(stored, "day", D("2024-02-01")).collect()} == {2, 3}
    listed = spark.createDataFrame([("b",), ("b",)], ["code"])
    assert rows(ingest.purge_delisted(stored, listed, "code")) == [("b", D("2024-01-01"), 3)]
    assert ingest.purge_delisted(stored, listed.limit(0), "code").count() == 0


def test_rows_after_stored(spark, rows):
    stored = prices(spark, [("a", D("2024-01-02"), 1)])
    fetched = prices(spark, [("a", D("2024-01-02"), 5), ("a", D("2024-01-03"), 6), ("b", D("2020-01-01"), 7)])
    assert rows(ingest.rows_after_stored(fetched, stored, "code", "day")) == [
        ("a", D("2024-01-03"), 6),
        ("b", D("2020-01-01"), 7),
    ]


# ---- listing


def test_ordinary_shares(spark):
    df = spark.createDataFrame(
        [("000020", "0", "ST"), ("00002", "0", "ST"), ("000021", "1", "ST"), ("000022", "0", "EF")],
        ["code", "share_class", "security_group"],
    )
    assert [r["code"] for r in listing.ordinary_shares(df).collect()] == ["000020"]


@pytest.mark.parametrize(
    "as_of,wanted", [("20240101", [("a", "20240101", "20240101")]), ("20240102", [("b", "20240102", None)])]
)
def test_snapshot(spark, rows, as_of, wanted):
    shape = "code string, etldate string, etlcheck string"
    snapshot = spark.createDataFrame([("a", "20240101", "20240101")], shape)
    source = spark.createDataFrame([("b",)], "code string")
    assert rows(listing.fresh_snapshot(snapshot, source, as_of)) == wanted


def test_snapshot_of_an_empty_store(spark, rows):
    snapshot = spark.createDataFrame([], "code string, etldate string, etlcheck string")
    source = spark.createDataFrame([("b",)], "code string")
    assert rows(listing.fresh_snapshot(snapshot, source, "20240102")) == [("b", "20240102", None)]


def test_status_round(spark, rows):
    df = spark.createDataFrame(
        [
            ("000020", "00", None),
            ("20", "00", ""),
            ("000030", "01", None),
            ("000035", None, None),
            ("000040", "00", "20240101"),
        ],
        "code string, price_change string, etlcheck string",
    )
    same, changed = listing.split_pending(df)
    assert {r["code"] for r in same.collect()} == {"000020", "20"}
    assert {r["code"] for r in changed.collect()} == {"000030", "000035"}
    done = listing.mark_done(df, spark.createDataFrame([("000020",), ("000020",)], ["code"]), "code", F.lit("20240102"))
    assert rows(done.select("code", "etlcheck")) == sorted(
        [("000020", "20240102"), ("20", ""), ("000030", None), ("000035", None), ("000040", "20240101")]
    )


# ---- consolidation


def test_codes_to_move(spark, rows):
    frame = lambda *codes: spark.createDataFrame([(c,) for c in codes], ["code"])
    moved = consolidate.codes_to_move(frame("a", "b", "c"), frame("a", "b", "x"), frame("b"), "code")
    assert rows(moved) == [("a",)]


def test_consolidated_tables_keep_codes_and_drop_copies(spark, rows):
    root = new_folder(spark, "tables")
    for code, data in {"000020": [(1,), (1,), (2,)], "000030": [(1,)]}.items():
        spark.createDataFrame(data, "v int").write.parquet(f"{root}/{code}.parquet")
    assert rows(consolidate.consolidated(spark, root, "v int")) == [(1, "000020"), (1, "000030"), (2, "000020")]
    only = consolidate.consolidated(spark, root, "v int", ["000030"])
    assert rows(only) == [(1, "000030")]
    assert all("000030.parquet" in path for path in only.inputFiles())


def test_consolidated_plain_files_and_encoded_codes(spark, rows, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for code in ("005930", "가나 B+", "a.b%"):
        pq.write_table(pa.table({"v": pa.array([1, 1], pa.int32())}), f"{tmp_path}/{code}.parquet")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{tmp_path}/folder 다.parquet")
    found = consolidate.consolidated(spark, str(tmp_path), "v int")
    assert rows(found) == sorted([(1, "005930"), (1, "가나 B+"), (1, "a.b%"), (2, "folder 다")])


def test_consolidating_twice_inserts_once(spark, rows):
    root = new_folder(spark, "tables")
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{root}/a.parquet")
    target = ("consolidated_twice", new_folder(spark, "target"))
    consolidate.consolidate_into(spark, *target, root, "v int")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{root}/b.parquet")
    assert rows(consolidate.consolidate_into(spark, *target, root, "v int")) == [(1, "a"), (2, "b")]
    assert rows(consolidate.consolidate_into(spark, *target, root, "v int")) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(1,), (None,), (3,)], "v int").write.mode("append").parquet(f"{root}/a.parquet")
    for _ in range(2):  # what a table gained is inserted, once
        assert rows(consolidate.consolidate_into(spark, *target, root, "v int")) == [(None, "a"), (1, "a"), (2, "b"), (3, "a")]


# ---- events


def event(i, login, kind="PushEvent", name="org/repo", at="2024-05-19T14:00:01Z", **payload):
    fields = {"repository_id": None, "size": None, "distinct_size": None, "comment": None, **payload}
    return (str(i), kind, True, at, (login, f"https://u/{login}"), (name, f"https://r/{name}"), None, tuple(fields.values()))


@pytest.fixture
def nested(spark):
    data = [
        event(1, "ann", size=3, distinct_size=2, comment=("hi",)),
        event(2, events.BOT),
        event(3, None),
        event(4, "bob", "ForkEvent", name="plain"),
        event(5, "ann", "WatchEvent", at="yesterday"),
        event(6, "bob", "PushEvent", distinct_size=5),
        event(7, "cat", "IssueCommentEvent", name=None),
    ]
    return spark.createDataFrame(data, events.NESTED)


def test_refined(nested):
    df = events.refined(nested)
    assert df.columns == [
        "user_name",
        "url",
        "created_at",
        "id",
        "repository_id",
        "size",
        "distinct_size",
        "comment",
        "type",
        "repo_url",
        "repo_name",
    ]
    found = {r["id"]: r for r in df.collect()}
    assert set(found) == {"1", "4", "5", "6", "7"}
    assert found["1"]["repo_name"] == "repo" and found["4"]["repo_name"] == "plain" and found["7"]["repo_name"] is None
    assert found["1"]["created_at"] == datetime.datetime(2024, 5, 19, 14, 0, 1) and found["5"]["created_at"] is None


def test_stats(nested):
    refined = events.refined(nested)
    repos = {r["repo_name"]: r.asDict() for r in events.repo_stats(refined).collect()}
    assert repos["repo"]["push_count"] == 2 and repos["repo"]["commit_count"] == 7 and repos["repo"]["watch_count"] == 1
    assert repos["plain"]["fork_count"] == 1 and repos["plain"]["commit_count"] == 0
    users = {r["user_name"]: r.asDict() for r in events.user_stats(refined).collect()}
    assert users["cat"]["issue_comment_count"] == 1 and users["ann"]["push_count"] == 1
    days = {r["day"]: r.asDict() for r in events.daily_stats(refined).collect()}
    assert days[D("2024-05-19")]["distinct_user_cnt"] == 3 and days[D("2024-05-19")]["distinct_repo_cnt"] == 3
    assert days[None]["push_count"] == 0


def test_top_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), ("d", 1)], ["k", "n"])
    assert [r["k"] for r in events.top(df, "n", ["k"], 3).collect()] == ["c", "a", "b"]


def test_parsed_flat_records(spark, nested):
    folder = new_folder(spark, "flat")
    nested.write.json(folder)
    flat = spark.read.schema(events.FLAT).json(folder)
    assert dict(flat.dtypes)["actor"] == "string"
    again = events.refined(events.parsed(flat))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, events.refined(nested).collect()))
    with_message = events.refined(events.parsed(flat, events.PAYLOAD_MESSAGE))
    assert "message" in with_message.columns and "comment" not in with_message.columns


def test_index_sink_options_and_publish(spark):
    options = IndexSink("host-a", id_column="id").options("daily")
    assert options == {NODES: "host-a", AUTO_CREATE: "yes", RESOURCE: "daily", ID: "id"}
    assert ID not in IndexSink("host-a").options("daily")
    assert IndexSink("host-a").format == CONNECTOR and IndexSink("host-a").mode == "append"
    folder = new_folder(spark, "index")
    sink = IndexSink("host-a", "id", format="json")
    for _ in range(2):
        events.publish(spark.createDataFrame([(1, "x")], ["id", "message"]), sink, folder, F.lit("2024-05-19"))
    assert [tuple(r) for r in spark.read.json(folder).select("id", "@timestamp").collect()] == [(1, "2024-05-19")] * 2


# ---- text


def test_text_statistics(spark, rows):
    lines = spark.createDataFrame([("one two two",), ("two  end",), (None,), ("",)], "value string")
    assert rows(textstats.word_count(lines)) == [("", 2), ("end", 1), ("one", 1), ("two", 3)]
    assert tuple(textstats.lines_with(lines, ["o", "n"]).first()) == (2, 2)


# ---- the daily run


@pytest.fixture
def daily(spark):
    listing_rows = [
        ("kept", D("2024-01-01"), "00", None),
        ("split", D("2024-01-01"), "00", None),
        ("told", D("2024-01-01"), "01", None),
        ("new", D("2024-01-03"), "00", None),
        ("down", D("2024-01-01"), "00", None),
        ("done", D("2024-01-01"), "00", "20240104"),
    ]
    listed = spark.createDataFrame(
        listing_rows, "code string, listed_day date, price_change string, etlcheck string"
    )
    stored = prices(
        spark,
        [(c, D(f"2024-01-0{i}"), 10 * i) for c in ("kept", "split", "told", "down", "done") for i in (1, 2)],
    )
    service = {
        (c, D(f"2024-01-0{i}")): 10 * i // (2 if c in ("split", "told") else 1)
        for c in ("kept", "split", "told", "new", "done")
        for i in (1, 2, 3, 4)
        if c != "new" or i > 2
    }
    asked = []

    def fetch(requests):
        windows = [(r["code"], r["from"], r["to"]) for r in requests.collect()]
        asked.append(windows)
        found = [
            (code, day, close)
            for (code, day), close in service.items()
            if any(code == c and a <= day <= b for c, a, b in windows)
        ]
        failed = [(c, a) for c, a, _ in windows if c == "down"]
        return prices(spark, found), spark.createDataFrame(failed, "code string, `from` date")

    return listed, stored, fetch, service, asked


def test_daily_update(spark, rows, daily):
    from candlemill.plans.daily import daily_update

    listed, stored, fetch, service, asked = daily
    update = daily_update(listed, stored, fetch, D("2024-01-04"))
    assert sorted(r["code"] for r in update.rebased.collect()) == ["split", "told"]
    after = update.kept.unionByName(update.added)
    found = {(c, d): x for c, d, x in rows(after)}
    assert len(found) == after.count()
    for code in ("kept", "split", "told", "new"):
        assert {k: v for k, v in found.items() if k[0] == code} == {k: v for k, v in service.items() if k[0] == code}
    assert {k[1] for k in found if k[0] in ("down", "done")} == {D("2024-01-01"), D("2024-01-02")}
    status = dict(rows(update.listing.select("code", "etlcheck")))
    assert {code for code, day in status.items() if day == "20240104"} == set(status) - {"down"}
    assert status["down"] is None
    assert [sorted({w[0] for w in windows}) for windows in asked] == [["down", "kept", "new", "split", "told"], ["split"]]


def test_second_daily_run_adds_nothing(spark, daily):
    from candlemill.plans.daily import daily_update

    listed, stored, fetch, _, _ = daily
    first = daily_update(listed, stored, fetch, D("2024-01-04"))
    after = first.kept.unionByName(first.added)
    again = daily_update(listed.where("price_change = '00'"), after, fetch, D("2024-01-04"))
    assert again.added.count() == 0 and again.rebased.count() == 0


def test_failed_windows_leave_no_hole_and_no_code_without_history(spark, rows):
    """Codes: one fails in its second of three windows, one announced rebase and one found one fail too."""
    from candlemill.plans.daily import daily_update

    last = D("2024-03-15")
    days = [D("2024-01-01") + datetime.timedelta(n) for n in range((last - D("2024-01-01")).days + 1)]
    listed = spark.createDataFrame(
        [("gap", days[0], "00", None), ("told", days[0], "01", None), ("found", days[0], "00", None)],
        "code string, listed_day date, price_change string, etlcheck string",
    )
    old = [(c, day, 10) for c in ("gap", "told", "found") for day in days[:5]]
    service = [(c, day, 10 if c == "gap" else 5) for c in ("gap", "told", "found") for day in days]
    runs = {"n": 0}

    def fetch(requests):
        windows = requests.collect()
        whole = {c for c, *_ in windows if sum(w["code"] == c for w in windows) == 3}
        bad = {
            (w["code"], w["from"])
            for w in windows
            if runs["n"] == 0 and w["from"] > days[0] and w["to"] < last and (w["code"] != "found" or w["code"] in whole)
        }
        served = [
            row
            for row in service
            for w in windows
            if row[0] == w["code"] and w["from"] <= row[1] <= w["to"] and (w["code"], w["from"]) not in bad
        ]
        return prices(spark, served), spark.createDataFrame(sorted(bad), "code string, `from` date")

    first = daily_update(listed, prices(spark, old), fetch, last)
    stored = first.kept.unionByName(first.added)
    found = {code: [(d, x) for c, d, x in rows(stored) if c == code] for code in ("gap", "told", "found")}
    assert [d for d, _ in found["gap"]] == days[: len(found["gap"])] and len(days) > len(found["gap"]) >= 5
    assert {x for _, x in found["told"]} == {10} and len(found["told"]) == 5
    assert rows(first.listing.select("etlcheck").distinct()) == [(None,)]
    runs["n"] = 1
    second = daily_update(first.listing, stored, fetch, last)
    assert rows(second.kept.unionByName(second.added)) == sorted(service)
    assert rows(second.listing.select("etlcheck").distinct()) == [("20240315",)]
