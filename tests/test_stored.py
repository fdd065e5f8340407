"""Exact quantiles, heavy keys, keyed tables, footers, committed batches, stored runs, changes, scratch folders."""

import datetime
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlemill.operators import heavy, profile, quantiles
from candlemill.plans import indicators as ind
from candlemill.plans.publish import Published, changes, digest_of
from candlemill.plans.store import STEPS, PriceStore, RunRecord
from candlemill.registry.base import daily_series
from candlemill.sinks import committed
from candlemill.sinks.index import IndexSink
from candlemill.sinks.tables import KeyedTable
from candlemill.sources import fetch, footers
from candlemill.workspace import new_folder, new_table, remove_all, scratch, shared_root, written

D = datetime.date.fromisoformat


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quantiles


@pytest.mark.parametrize("accuracy", [20, 2000])
def test_quantiles_of_odd_columns(spark, accuracy):
    dice = np.random.default_rng(accuracy)
    pdf = pd.DataFrame(
        {
            "even": dice.integers(0, 10**6, 3000).astype(float),
            "few": dice.integers(0, 4, 3000).astype(float),
            "heavy": np.where(dice.random(3000) < 0.7, 5.0, dice.normal(size=3000)),
            "wide": 10.0 ** dice.uniform(-300, 300, 3000) * dice.choice([-1, 1], 3000),
            "holes": np.where(dice.random(3000) < 0.5, np.nan, dice.normal(size=3000)),
            "same": 7.0,
        }
    )
    df = spark.createDataFrame(pdf).repartition(5)
    wanted = [0.0, 0.25, 0.5, 0.999, 1.0]
    found = {(r["column"], r["quantile"]): r["value"] for r in quantiles.exact_quantiles(df, pdf.columns, wanted, accuracy).collect()}
    for name in pdf.columns:
        values = np.sort(pdf[name].dropna().to_numpy())
        for q in wanted:
            assert found[name, q] == values[quantiles.rank_of(q, len(values)) - 1], (name, q)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, float("nan"), 3)], "a double, b double, c int")
    found = quantiles.exact_quantiles(df, ["a", "b", "c"], [0.5]).collect()
    assert [(r["column"], r["value"]) for r in found] == [("a", None), ("b", None), ("c", 3.0)]
    assert quantiles.exact_quantiles(df.limit(0), ["c"], [0.5]).first()["value"] is None
    assert profile.exact_summary(df, ["a", "c"]).orderBy("column").first()["median"] is None


def test_quantiles_do_not_sort(spark, monkeypatch):
    """Two aggregates a pass, and few passes."""
    passes = []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda target, *told: passes.append(target) or narrowed(target, *told))
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("x"))
    values = np.sort(df.toPandas()["x"])
    assert quantiles.exact_quantiles(df, ["x"], [0.5]).first()["value"] == values[99_999]
    assert len(passes) <= 4


# ---- partitions and buckets


def test_partition_rows_are_the_arrays_of_the_partitions(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 2).repartitionById(4, (F.col("id") % 4).cast("int"))
    arrays = df.select("v").rdd.glom().map(lambda rows: [row["v"] for row in rows]).collect()
    found = sorted(map(tuple, profile.partition_rows(df.select("v")).collect()))
    assert found == [(p, i, v) for p, values in enumerate(arrays) for i, v in enumerate(values)]


def test_hash_bucket_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = profile.hash_bucket_rows(lines, ["l_suppkey"], 20).collect()
    assert {row["bucket"] for row in found} <= set(range(20)) and len(found) > 10
    assert sum(row["rows"] for row in found) == lines.count()
    assert sum(row["keys"] for row in found) == lines.select("l_suppkey").distinct().count()


# ---- heavy keys


@pytest.mark.parametrize("capacity", [8, 64, 4096])
def test_top_keys_equal_the_plain_ones(spark, capacity):
    dice = random.Random(capacity)
    rows = [(f"k{min(int(dice.paretovariate(0.8)), 3000)}", dice.choice("ab"), dice.randrange(4)) for _ in range(8000)]
    rows += [(None, "a", 1)] * 700 + [("k1", None, None)] * 50
    df = written(spark.createDataFrame(rows, "k string, s string, w int").repartition(6), "rows")
    for weight in (None, F.col("w")):
        total = F.sum(F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))).cast("long").alias("n")
        plain = df.groupBy("k", "s").agg(total).orderBy(F.desc("n"), "k", "s").limit(6).collect()
        assert heavy.top_keys(df, ["k", "s"], 6, weight, capacity=capacity).collect() == plain


def test_only_candidates_are_counted(spark):
    """A hundred heavy keys among fifty thousand: the second round's rows are theirs, or nearly."""
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 100).otherwise(1000 + F.col("id") % 50_000).alias("k"))
    rows = written(rows.repartition(4), "rows")
    found, many = heavy.heavy_candidates(rows, ["k"], 50, F.lit(1), 2000)
    assert 50 <= many <= 200
    top = heavy.top_keys(rows, ["k"], 50, capacity=2000)
    assert {row["k"] for row in top.collect()} <= set(range(100)) and top.count() == 50
    assert "BroadcastHashJoin" in plan_of(top) and "LeftSemi" in plan_of(top)


def test_keys_that_are_all_alike_are_counted_in_full(spark):
    rows = written(spark.range(5000).select((F.col("id") % 2500).alias("k")), "rows")
    assert heavy.heavy_candidates(rows, ["k"], 10, F.lit(1), 16) == (None, 0)
    assert [(r["k"], r["n"]) for r in heavy.top_keys(rows, ["k"], 3, capacity=16).collect()] == [(0, 2), (1, 2), (2, 2)]
    assert heavy.top_keys(rows.limit(0), ["k"], 3).count() == 0


# ---- walks


def walk(spark, tmp_path, windows, **options):
    """Rows, errors, calls, and the calls that the service saw, in order, per key."""
    seen = str(tmp_path / "seen")
    os.makedirs(seen)

    def answer(request):
        with open(f"{seen}/{request['code']}", "a") as out:
            out.write(f"{request['from']}\n")
        if request["n"] < 0:
            raise OSError("down")
        return {"code": [request["code"]] * request["n"], "w": [request["from"]] * request["n"]}

    requests = spark.createDataFrame(windows, "code string, from int, n int").repartition(5)
    frames = fetch.walk_windows(requests, answer, spark.createDataFrame([], "code string, w int").schema, "code", "from", 0.0, 3, **options)
    rows, errors, calls = (sorted(map(tuple, df.collect()), key=str) for df in frames)
    made = {name: [int(line) for line in open(f"{seen}/{name}")] for name in os.listdir(seen)}
    return rows, errors, dict(calls), made


def test_a_walk_ends_at_the_second_empty_window(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fetch, "CALLS_PER_BATCH", 3)
    windows = [("gap", w, 0 if w in (7, 4) else 2) for w in range(10)]
    windows += [("one", w, 0 if w == 5 else 1) for w in range(10)]
    windows += [("none", w, 0) for w in range(10)]
    windows += [("bad", w, -1 if w % 2 else 1) for w in range(6)]
    windows += [(f"c{i}", w, 1) for i in range(20) for w in range(3)]
    rows, errors, calls, made = walk(spark, tmp_path, windows)
    assert made["gap"] == [9, 8, 7, 6, 5, 4] and made["none"] == [9, 8] and made["one"] == list(range(9, -1, -1))
    assert made["bad"] == [5, 4, 3, 2, 1, 0] and [e[:2] for e in errors] == [("bad", 1), ("bad", 3), ("bad", 5)]
    assert calls == {name: len(of) for name, of in made.items()}
    assert [r for r in rows if r[0] == "gap"] == [("gap", w) for w in (5, 5, 6, 6, 8, 8, 9, 9)]
    assert sum(r[0] == "one" for r in rows) == 9 and sum(r[0].startswith("c") for r in rows) == 60


def test_a_walk_of_nothing_and_another_limit(spark, tmp_path):
    assert walk(spark, tmp_path / "a", []) == ([], [], {}, {})
    assert walk(spark, tmp_path / "b", [("x", w, 0) for w in range(9)], most_empty=3)[3] == {"x": [8, 7, 6, 5]}


# ---- a table that takes rows if absent


def test_the_table_is_not_shuffled_for_an_insert(spark):
    stored = KeyedTable(spark, new_table("keyed"), new_folder(spark, "keyed"), ("code", "day"), buckets=8)
    days = spark.range(3000).select((F.col("id") % 30).alias("code"), F.date_add(F.lit(D("2000-01-01")), (F.col("id") / 30).cast("int")).alias("day"), "id")
    stored.insert(days.where("id < 2000"))
    stored.insert(days.where("id >= 1500").unionByName(days.where("id >= 2500")).withColumn("id", F.col("id") + 0))
    assert stored.rows().count() == 3000 == stored.rows().select("code", "day").distinct().count()
    plan = plan_of(stored.absent(days))
    join = plan[plan.index("SortMergeJoin") :]
    assert "LeftAnti" in join
    left, _, right = join.rpartition("+- Sort")
    assert "Exchange" not in right and "FileScan" in right and "Exchange" in left
    assert stored.absent(days).count() == 0
    assert len([name for name in os.listdir(stored.path.removeprefix("file:")) if name.endswith(".parquet")]) == 16
    stored.insert(spark.createDataFrame([(None, D("2000-01-01"), 1), (99, None, 1), (99, D("2000-01-01"), 1)], "code long, day date, id long"))
    assert stored.rows().count() == 3001


# ---- footers


def test_bounds_come_from_footers(spark, tmp_path, sf_dir):
    path = str(tmp_path / "series")
    series = daily_series(spark, sf_dir)
    series.withColumn("part", F.col("code") % 3).write.partitionBy("part").parquet(path)
    found = footers.footer_aggregates(spark, path, {"mark": ("max", "day"), "n": ("count", "*")})
    assert "PushedAggregation: [MAX(day), COUNT(*)]" in plan_of(found).replace("`", "")
    assert "close" not in plan_of(found)
    assert tuple(found.first()) == tuple(series.agg(F.max("day"), F.count("*")).first())
    assert footers.high_water_mark(spark, path, "day") == found.first()["mark"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    by = footers.footer_aggregates(spark, path, {"n": ("count", "day")}, by=["part"])
    assert sum(row["n"] for row in by.collect()) == series.count()
    spark.createDataFrame([("x",)], "s string").write.parquet(f"{path}2")
    with pytest.raises(TypeError):
        footers.high_water_mark(spark, f"{path}2", "s")


# ---- committed batches


def test_a_failed_write_shows_nothing_and_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).repartition(4)
    committed.write_committed(df.where("id < 50"), path, "one")

    def failing(batches):
        yield from batches
        if TaskContext.get().partitionId() == 1:
            raise OSError("full")

    with pytest.raises(PySparkException):
        committed.write_committed(df.mapInArrow(failing, df.schema), path, "two")
    assert sorted(r["id"] for r in committed.read_committed(spark, path, "id long").collect()) == list(range(50))
    listed = {row["file"] for row in committed.manifests(spark, path).collect()}
    assert listed <= set(os.listdir(f"{path}/data"))
    for _ in range(2):  # the same batch again takes the place of the first
        committed.write_committed(df.where("id >= 50"), path, "two")
    assert sorted(r["id"] for r in committed.read_committed(spark, path, "id long").collect()) == list(range(100))
    assert committed.manifests(spark, path).agg(F.sum("rows")).first()[0] == 100


def test_an_empty_batch_and_names(spark, tmp_path):
    path = str(tmp_path / "out")
    assert committed.read_committed(spark, path, "id long").count() == 0
    committed.write_committed(spark.range(0), path, "none")
    assert committed.read_committed(spark, path, "id long").count() == 0
    for name in ("", "a/b", ".x"):
        with pytest.raises(ValueError):
            committed.write_committed(spark.range(1), path, name)


# ---- stored runs


@pytest.fixture
def history(spark):
    """(listing, first history, service): one code goes on, one is rebased, one is new, one gets nothing."""
    days = [D("2024-01-01") + datetime.timedelta(n) for n in range(80)]
    codes = ["on", "split", "new", "idle"]
    served = [(c, d, (n * 7 + len(c)) % 50 + (100 if c == "split" else 1), n + 1) for c in codes for n, d in enumerate(days) if c != "idle" or n < 40]
    shape = "code string, day date, close bigint, volume bigint"
    service = written(spark.createDataFrame(served, shape), "service")
    first = service.where("code <> 'new' and day < date '2024-02-10'").withColumn("close", F.expr("if(code = 'split', close - 90, close)"))
    listing = spark.createDataFrame([(c, days[0], "00", None) for c in codes], "code string, listed_day date, price_change string, etlcheck string")

    def ask(requests):
        spans = written(requests, "asked").select("code", F.explode(F.sequence("from", "to")).alias("day"))
        return written(service.join(spans, ["code", "day"], "left_semi"), "answered"), requests.limit(0)

    return listing, written(first, "first"), service, ask


class Died(Exception):
    pass


def test_a_run_that_dies_in_every_step_is_resumed(spark, monkeypatch, history):
    """A step's work is done when the driver dies, its mark is not: each step is done twice."""
    listing, first, service, ask = history
    store = PriceStore(spark, new_folder(spark, "store"), "code string, day date, close bigint, volume bigint", spans=(5,), buckets=4)
    store.load(first)
    mark, died, asked = RunRecord.mark, set(), []

    def dying(self, step):
        if step not in died:
            died.add(step)
            raise Died
        mark(self, step)

    monkeypatch.setattr(RunRecord, "mark", dying)
    for at in range(len(STEPS)):
        with pytest.raises(Died):
            store.daily("r", listing, lambda requests: asked.append(at) or ask(requests), D("2024-03-25"))
    record = store.daily("r", listing, ask, D("2024-03-25"))
    assert record.done() == died == set(STEPS) and set(asked) == {0, 1}
    assert sorted(map(tuple, store.read("prices").collect())) == sorted(map(tuple, service.collect()))
    wanted = {(r["code"], r["day"]): r["eavg_close_5"] for r in ind.indicators(service, [5]).collect()}
    found = {(r["code"], r["day"]): r["eavg_close_5"] for r in store.read("indicators").collect()}
    assert found == pytest.approx(wanted, rel=1e-9) and store.read("indicators").count() == len(wanted)
    ends = {r["code"]: r["last_day"] for r in ind.block_states(store.read("blocks"), [5]).collect()}
    assert ends == {r["code"]: r["d"] for r in service.groupBy("code").agg(F.max("day").alias("d")).collect()}
    assert {r["etlcheck"] for r in store.listing("r").collect()} == {"20240325"}


def test_keys_of_rows_are_not_broadcast_by_a_step(spark, monkeypatch, history):
    """Rows of an attempt that died are found by their keys, which are as many as the new rows."""
    from candlemill.plans import store as module

    listing, first, _, ask = history
    store = PriceStore(spark, new_folder(spark, "store"), "code string, day date, close bigint, volume bigint", spans=(5,), buckets=4)
    store.load(first)
    replace, plans = module.replace_buckets, []

    def watched(spark, path, shape, keys, touched, change, buckets):
        replace(spark, path, shape, keys, touched, lambda rows: plans.append((path, change(rows))) or plans[-1][1], buckets)

    monkeypatch.setattr(module, "replace_buckets", watched)
    store.daily("r", listing, ask, D("2024-03-25"))
    (changed,) = [df for path, df in plans if path.endswith("/indicators")]
    joins = [line for line in changed._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "day#" in line]
    assert any("SortMergeJoin" in line and "LeftAnti" in line for line in joins)


def test_a_finished_run_does_nothing(spark, history):
    listing, first, service, ask = history
    store = PriceStore(spark, new_folder(spark, "store"), "code string, day date, close bigint, volume bigint", spans=(5,), buckets=4)
    store.load(first)
    store.daily("r", listing, ask, D("2024-03-25"))

    def no_service(requests):
        raise AssertionError("asked again")

    store.daily("r", listing, no_service, D("2024-03-25"))
    assert store.read("prices").count() == service.count() == store.read("indicators").count()


# ---- publishing changes


def test_only_changes_are_sent(spark, tmp_path):
    shape = "id string, `@timestamp` string, k string, n long"
    first = spark.createDataFrame([("1", "t1", "a", 1), ("2", "t1", "b", 2), ("3", "t1", None, None)], shape)
    second = spark.createDataFrame([("1", "t2", "a", 1), ("2", "t2", "b", 5), ("4", "t2", "d", 4)], shape)
    sink, published = IndexSink(hosts="h", id_column="id", format="json"), Published(spark, str(tmp_path / "digests"))
    sent = [sorted((r["id"], r["n"], r["operation"]) for r in published.publish(docs, sink, f"{tmp_path}/out{n}").collect()) for n, docs in enumerate([first, second, second, first])]
    assert sent[0] == [("1", 1, "index"), ("2", 2, "index"), ("3", None, "index")]
    assert sent[1] == [("2", 5, "index"), ("3", None, "delete"), ("4", 4, "index")]
    assert sent[2] == []
    assert sent[3] == [("2", 2, "index"), ("3", None, "index"), ("4", None, "delete")]
    assert published.last() == 4 and published.digests().count() == 3


def test_a_publication_that_dies_is_sent_again(spark, tmp_path):
    docs = spark.createDataFrame([("1", "a")], "id string, k string")
    published = Published(spark, str(tmp_path / "digests"))

    class Broken(IndexSink):
        def write(self, df, resource):
            raise OSError("down")

    with pytest.raises(OSError):
        published.publish(docs, Broken(hosts="h"), "x")
    assert published.last() == 0
    assert changes(docs, published.digests()).count() == 1
    assert digest_of(docs.withColumn("@timestamp", F.lit("x"))) is not None


# ---- scratch folders


def test_scratch_is_empty_afterwards(spark):
    root = shared_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    kept = new_folder(spark, "kept")
    with scratch(spark):
        inner = written(spark.range(10), "inner")
        name = new_table("scratched")
        inner.write.option("path", new_folder(spark, "table")).saveAsTable(name)
        inner.write.parquet(kept)
        with pytest.raises(ValueError), scratch(spark):
            written(spark.range(3), "deeper")
            raise ValueError
        assert spark.catalog.tableExists(name) and inner.count() == 10
    assert not spark.catalog.tableExists(name)
    assert set(os.listdir(root)) - before == {os.path.basename(kept)}
    assert spark.read.parquet(kept).count() == 10


def test_what_is_left_goes_when_the_driver_ends(spark, tmp_path, monkeypatch):
    from candlemill import workspace

    monkeypatch.setattr(workspace, "_made", {})
    folder = new_folder(spark, "left")
    spark.range(3).write.parquet(folder)
    remove_all()
    assert not os.path.exists(folder.removeprefix("file:")) and workspace._made == {}
