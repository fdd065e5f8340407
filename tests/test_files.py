"""Sources and sinks through files; JDBC options without a database."""

import datetime
import gzip
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.plans.events import NESTED
from candlemill.sinks import jdbc as jdbc_sink
from candlemill.sinks.index import IndexSink
from candlemill.sinks.tables import append_bucketed, export_csv, read_bucketed, replace_buckets
from candlemill.sources import catalog, fetch, files, jdbc, master
from candlemill.streaming.events import landed_events, publish_landed
from candlemill.workspace import new_folder, shared_root, written

D = datetime.date.fromisoformat
RECORD = {
    "id": "1",
    "type": "PushEvent",
    "public": True,
    "created_at": "2024-05-19T14:00:01Z",
    "actor": {"login": "ann", "url": "https://u/ann"},
    "repo": {"name": "org/repo", "url": "https://r/org/repo"},
    "payload": {"size": 1, "distinct_size": 1},
}


# ---- workspace


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x").startswith(shared_root(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_written_tables_have_no_lineage(spark):
    df = written(spark.range(5).withColumn("d", F.lit(1.5)), "kept")
    assert df.count() == 5
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


# ---- json


def test_missing_json(spark, tmp_path):
    rows, errors = files.read_json(spark, f"{tmp_path}/none*.json", "a int")
    assert (rows.columns, errors.columns) == (["a"], ["path", "line", "kept"])
    assert (rows.count(), errors.count()) == (0, 0)
    with pytest.raises(AnalysisException):
        files.read_json(spark, f"{tmp_path}/none*.json")


def test_archive_day_reads_hours_0_to_23(spark, tmp_path):
    for path in files.archive_hours(str(tmp_path), "2024-05-19"):
        with gzip.open(path, "wt") as out:
            out.write(json.dumps(RECORD) + "\n")
    with gzip.open(f"{tmp_path}/2024-05-20-0.json.gz", "wt") as out:
        out.write(json.dumps(RECORD) + "\n")
    day, errors = files.read_archive_day(spark, str(tmp_path), "2024-05-19", NESTED, partitions=4)
    assert (day.count(), errors.count()) == (24, 0)
    assert day.rdd.getNumPartitions() == 4


def test_quoted_id_under_a_number_schema_is_null(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id":"5"}\n')
    rows, errors = files.read_json(spark, str(tmp_path), "id long")
    assert [row["id"] for row in rows.collect()] == [None]
    assert [(row["line"], row["kept"]) for row in errors.collect()] == [('{"id":"5"}', True)]
    rows, errors = files.read_json(spark, str(tmp_path), "id string")
    assert (rows.first()["id"], errors.count()) == ("5", 0)


BROKEN_LINES = [
    '{"a":1,"b":{"c":"x"}}', '{"a":2,"b":{"c"', "", "   ", '[{"a":3},{"a":4}]', "null", "7", "not json",
    ' {"a":5,"b":{"c":null}}', '{"a":"six","b":{"c":"y"}}', '{"b":"flat"}', "{}", '{"a":7} trailing',
]


def _write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_broken_lines_are_told(spark, tmp_path):
    _write_lines(tmp_path / "one.json", BROKEN_LINES)
    _write_lines(tmp_path / "two.json", ['{"a":9}', '{"a":'])
    rows, errors = files.read_json(spark, str(tmp_path), "a int, b struct<c: string>")
    assert sorted((r["a"], r["b"] and r["b"]["c"]) for r in rows.where("a is not null").collect()) == [(1, "x"), (5, None), (7, None), (9, None)]
    assert rows.where("a is null").count() == 3  # the text for a number, the flat b, the empty object
    told = {row["line"].strip(): row["kept"] for row in errors.collect()}
    assert told == {
        '{"a":2,"b":{"c"': False, '[{"a":3},{"a":4}]': False, "null": False, "7": False, "not json": False,
        '{"a":"six","b":{"c":"y"}}': True, '{"b":"flat"}': True, '{"a":': False,
    }
    assert rows.select("a").count() == rows.count() == 7 and errors.count() == 8
    counted = {row["path"].rsplit("/", 1)[1]: (row["lines"], row["lost"]) for row in files.errors_per_file(errors).collect()}
    assert counted == {"one.json": (7, 5), "two.json": (1, 1)}


def test_a_large_landed_file_comes_in_parts(spark, smallest, rows, monkeypatch):
    """No task sorts all lines of a file; the parts are told together."""
    from candlemill.registry import events
    from candlemill.workspace import written

    raw = written(events.raw_events(spark, smallest).repartition(8), "raw")
    whole = rows(events._events_malformed_files(spark, smallest))
    monkeypatch.setattr(events, "raw_events", lambda spark, d: raw)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4k")
    try:
        counted = rows(events.errors_per_file(events._malformed(spark, smallest)[1]))
        assert len(counted) > events.FILES == len(whole)
        assert rows(events._events_malformed_files(spark, smallest)) == whole
    finally:
        spark.conf.set(name, before)


def test_inferred_schema_comes_from_whole_lines(spark, tmp_path):
    _write_lines(tmp_path / "one.json", ['{"a":1}', '{"a":2,"b":', '{"a":3,"c":"z"}'])
    rows, errors = files.read_json(spark, str(tmp_path))
    assert sorted(map(tuple, rows.select("a", "c").collect()), key=str) == [(1, None), (3, "z")]
    assert [row["line"] for row in errors.collect()] == ['{"a":2,"b":']


def test_schema_with_odd_names(spark, tmp_path):
    _write_lines(tmp_path / "one.json", ['{"a b":1,"@x":"y","path":"p"}'])
    rows, _ = files.read_json(spark, str(tmp_path), "`a b` int, `@x` string, path string")
    assert tuple(rows.first()) == (1, "y", "p")


def test_expired_files_by_name(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-31", "2024-02-01"):
        (tmp_path / f"{day}-3.json.gz").write_bytes(b"x")
    (tmp_path / "notes.txt").write_bytes(b"x")
    found = files.expired_files(spark, str(tmp_path), F.date_sub(F.lit("2024-03-02").cast("date"), 30))
    assert sorted(r["landed"] for r in found.collect()) == [D("2024-01-01"), D("2024-01-31")]
    assert "content" not in found.columns


# ---- fixed width


def line(head, layout, values, name):
    tail = "".join(values.get(field, "").ljust(width) for field, width in layout)
    return head[0].ljust(9) + head[1].ljust(12) + name + tail


@pytest.mark.parametrize(
    "layout,head,width,count,read",
    [
        (master.MAIN_MARKET, master.MAIN_MARKET_HEAD, 227, 70, master.read_main_market),
        (master.SECOND_MARKET, master.SECOND_MARKET_HEAD, 221, 64, master.read_second_market),
    ],
)
def test_security_master(spark, tmp_path, layout, head, width, count, read):
    fields = layout
    assert (sum(w for _, w in fields), len(fields)) == (width, count)
    first, last = fields[0][0], fields[-1][0]
    dated = next(name for name, w in fields if name.endswith("상장일자") or name.endswith("상장 일자"))
    text = [
        line(("000020", "KR7000020008"), layout, {first: "ST", last: "Y", dated: "19760324"}, "가나다 주식   "),
        line(("900110", "HK0000057197"), layout, {first: "FS"}, "x"),
    ]
    text += ["", "   ", text[0][:100]]
    (tmp_path / "codes.mst").write_bytes("\n".join(text).encode("cp949") + b"\n")
    found, errors = read(spark, str(tmp_path / "codes.mst"))
    rows = {r[head[0]]: r for r in found.collect()}
    assert [r["line"] for r in errors.collect()] == [text[0][:100]]
    assert set(rows) == {"000020", "900110"}
    assert rows["000020"][head[1]] == "KR7000020008"
    assert rows["000020"][head[2]] == "가나다 주식"
    assert (rows["000020"][first], rows["000020"][last], rows["000020"][dated]) == ("ST", "Y", "19760324")
    assert (rows["900110"][head[2]], rows["900110"][last]) == ("x", "")


# ---- fetch


def test_fetch_calls_once_per_request_and_keeps_failures(spark, tmp_path, rows):
    log = tmp_path / "calls"
    log.mkdir()
    folder = str(log)

    def answer(request):
        import uuid

        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(request["code"])
        if request["code"] == "bad":
            raise ConnectionError("no answer")
        return {"code": [request["code"]] * request["n"], "n": list(range(request["n"]))}

    requests = spark.createDataFrame([("a", 2), ("bad", 1), ("b", 0), ("c", 1)], "code string, n int")
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.LongType())])
    found, errors = fetch.fetch_windows(requests, answer, schema, pause=0.0, parallelism=2)
    assert rows(found) == [("a", 0), ("a", 1), ("c", 0)]
    assert rows(errors) == [("bad", 1, "ConnectionError: no answer")]
    assert len(list(log.iterdir())) == 4


# ---- tables


SHAPE = "code string, v int"


def test_short_answers_cost_no_sleep_and_one_conversion_together(monkeypatch):
    """Answers become arrays together; a value that doesn't fit is the error of its call alone."""
    import pyarrow as pa

    from candlemill.sources import fetch

    def no_sleep(pause):
        raise AssertionError("slept without a pause")

    made, as_array, shared = [], fetch._as_array, [0]
    monkeypatch.setattr(fetch.time, "sleep", no_sleep)
    monkeypatch.setattr(fetch, "_as_array", lambda *given: made.append(given) or as_array(*given))

    def answer(request):
        if request["n"] == "reused":
            shared[0] += 1
            return {"a": shared, "b": ["x"]}
        if request["n"] == "tuple":
            return {"a": (1, 2), "b": ["x", None]}
        return {"good": {"a": [1, None], "b": ["x", "y"]}, "none": {"a": [], "b": []}, "text": {"a": ["t"], "b": ["x"]},
                "uneven": {"a": [1, 2], "b": ["x"]}}[request["n"]]

    item = pa.struct([("a", pa.int64()), ("b", pa.string())])
    arrow = pa.schema([("request", pa.struct([("n", pa.string())])), ("error", pa.string()), ("rows", pa.list_(item))])
    call = fetch._caller(answer, item, 0.0)

    def told(*names):
        asked = pa.RecordBatch.from_pydict({"n": list(names)})
        out = fetch._told(asked, [call(request) for request in asked.to_pylist()], arrow).to_pylist()
        assert [row["request"]["n"] for row in out] == list(names)
        return [row["error"] and row["error"].split(":")[0] for row in out], [[tuple(r.values()) for r in row["rows"]] for row in out]

    good = [(1, "x"), (None, "y")]
    assert told("good", "none", "lost", "good", "reused", "reused") == (
        [None, None, "KeyError", None, None, None],
        [good, [], [], good, [(1, "x")], [(2, "x")]],
    )
    assert len(made) == 1
    assert told("none", "lost") == ([None, "KeyError"], [[], []])
    assert told("good", "text", "none", "uneven", "tuple") == (
        [None, "ArrowInvalid", None, "ArrowInvalid", None],
        [good, [], [], [], [(1, "x"), (2, None)]],
    )


def test_bucketed_table_append_replace(spark, rows):
    path = new_folder(spark, "table")
    assert read_bucketed(spark, path, SHAPE).count() == 0
    first = spark.createDataFrame([(f"{i:06d}", i) for i in range(40)], SHAPE)
    append_bucketed(first, path, ["code"], 4)
    append_bucketed(spark.createDataFrame([("new", 1)], SHAPE), path, ["code"], 4)
    assert read_bucketed(spark, path, SHAPE).count() == 41
    gone = spark.createDataFrame([("000003",), ("000017",)], ["code"])
    replace_buckets(spark, path, SHAPE, ["code"], gone, lambda r: r.join(gone, "code", "left_anti"), 4)
    left = {r["code"] for r in read_bucketed(spark, path, SHAPE).collect()}
    assert len(left) == 39 and not left & {"000003", "000017"}


def test_another_number_of_buckets_is_refused(spark):
    path = new_folder(spark, "table")
    df = spark.createDataFrame([(f"{i:06d}", i) for i in range(100)], SHAPE)
    append_bucketed(df, path, ["code"], 4)
    with pytest.raises(ValueError, match="4 buckets"):
        replace_buckets(spark, path, SHAPE, ["code"], df, lambda r: r, 16)
    with pytest.raises(ValueError, match="4 buckets"):
        append_bucketed(df, path, ["code"], 16)
    assert read_bucketed(spark, path, SHAPE).count() == 100


def test_a_replacement_reads_only_the_buckets_it_touches(spark):
    path = new_folder(spark, "table")
    append_bucketed(spark.createDataFrame([(f"{i:06d}", i) for i in range(100)], SHAPE), path, ["code"], 16)
    touched = spark.createDataFrame([("000003",)], ["code"])
    seen = []

    def change(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    replace_buckets(spark, path, SHAPE, ["code"], touched, change, 16)
    assert "PartitionFilters: [isnotnull(bucket" in seen[0]
    with pytest.raises(ValueError, match="no touched key"):
        replace_buckets(spark, path, SHAPE, ["code"], touched, lambda r: r.withColumn("code", F.lit("000009")), 16)


def test_replacing_every_row_of_a_bucket_empties_it(spark):
    path = new_folder(spark, "table")
    append_bucketed(spark.createDataFrame([("a", 1)], SHAPE), path, ["code"], 1)
    touched = spark.createDataFrame([("a",)], ["code"])
    replace_buckets(spark, path, SHAPE, ["code"], touched, lambda r: r.where("code != 'a'"), 1)
    assert read_bucketed(spark, path, SHAPE).count() == 0
    append_bucketed(spark.createDataFrame([("a", 2)], SHAPE), path, ["code"], 1)
    assert read_bucketed(spark, path, SHAPE).count() == 1


def test_csv_export_per_key_in_order(spark, tmp_path):
    data = [("069500", 20240102, 2), ("069500", 20240101, 1), ("114800", 20240101, 9)]
    df = spark.createDataFrame(data, ["t", "date", "close"])
    export_csv(df, f"{tmp_path}/out", "t", "date")
    back = spark.read.option("header", "true").schema("date int, close int").csv(f"{tmp_path}/out/t=069500")
    assert [tuple(r) for r in back.collect()] == [(20240101, 1), (20240102, 2)]


# ---- catalog


def test_catalog_listing(spark):
    spark.range(1).createOrReplaceTempView("candlemill_seen")
    listed = {r["name"]: r for r in catalog.table_list(spark).collect()}
    assert listed["candlemill_seen"]["temporary"]


# ---- jdbc: no database runs here, so what is sent is checked


def test_jdbc_read_options():
    options = jdbc.read_options("jdbc:x", table="prices", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "prices", "fetchsize": "1000", "user": "u"}
    assert jdbc.read_options("jdbc:x", query="select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x")
    assert jdbc.bounded_options("id", 1, 9, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "9",
        "numPartitions": "4",
    }


def test_jdbc_predicates_cover_every_code_once(spark):
    codes = [None, "", "000020", "005930", "069500", "114800", "it's", "zz"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    predicates = jdbc.range_predicates("code", ["005930", "114800", "it's"])
    assert len(predicates) == 4
    hits = [r["code"] for p in predicates for r in df.where(p.replace("''", "\\'")).collect()]
    assert sorted(hits, key=str) == sorted(codes, key=str)
    assert jdbc.range_predicates("code", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        jdbc.range_predicates("code", ["b", "a"])


def test_jdbc_append_options():
    assert jdbc_sink.append_options("jdbc:x", "t", 4, user="u") == {
        "url": "jdbc:x",
        "dbtable": "t",
        "numPartitions": "4",
        "batchsize": "10000",
        "user": "u",
    }


# ---- stream


def test_landed_files_are_published_once(spark, tmp_path):
    landed, resource, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    sink = IndexSink("host-a", "id", format="json")

    def land(name, record):
        (tmp_path / "in" / name).write_text(json.dumps(record) + "\n")
        query = publish_landed(spark, landed, sink, resource, checkpoint, "2024-05-19 00:00:00")
        query.awaitTermination(60)
        return sorted(r["id"] for r in spark.read.json(resource).collect())

    assert land("2024-05-19-0.json", RECORD) == ["1"]
    assert land("2024-05-19-1.json", {**RECORD, "id": "2"}) == ["1", "2"]


def test_broken_lines_of_a_stream_are_kept(spark, tmp_path):
    landed, resource, checkpoint, errors = (str(tmp_path / name) for name in ("in", "out", "state", "errors"))
    (tmp_path / "in").mkdir()
    sink = IndexSink("host-a", "id", format="json")
    for number, line in enumerate([json.dumps(RECORD), '{"id": "9", "ty', "\n"]):
        (tmp_path / "in" / f"2024-05-19-{number}.json").write_text(line + "\n")
        publish_landed(spark, landed, sink, resource, checkpoint, "2024-05-19 00:00:00", errors).awaitTermination(60)
    assert [row["id"] for row in spark.read.json(resource).collect()] == ["1"]
    told = spark.read.parquet(errors).where("line is not null").collect()
    assert [(row["line"], row["kept"], row["path"].rsplit("/", 1)[1]) for row in told] == [('{"id": "9", "ty', False, "2024-05-19-1.json")]


def test_landed_events_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({**RECORD, "id": str(number)}) for number in range(5)] + ["{", "[]"]
    (tmp_path / "in" / "one.json").write_text("\n".join(lines))
    events = landed_events(spark, str(tmp_path / "in"), files_per_trigger=1)
    assert events.isStreaming
    query = events.writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(row["id"] for row in spark.table("landed").collect()) == list("01234")
