"""Exact dedup: which row stays, and what the index remembers."""

import collections

from pyspark.sql import functions as F

from candlemill.llm import exact, queries


def fates(df, index, batch="b1"):
    rows = exact.deduplicated(df, index, batch).collect()
    return collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows)


def test_largest_id_stays(spark, documents):
    df = documents([(1, "x"), (5, "x"), (3, "x"), (2, "y"), (4, None), (6, "")])
    assert fates(df, queries.new_index(spark)) == collections.Counter(
        {(1, 5, 3, False): 1, (5, 5, 3, True): 1, (3, 5, 3, False): 1, (2, 2, 1, True): 1, (4, 6, 2, False): 1, (6, 6, 2, True): 1}
    )


def test_repeated_rows_and_null_ids(spark, documents):
    df = documents([(1, "x")] * 4 + [(None, "n")] * 2 + [(None, "m"), (0, "m")])
    found = fates(df, queries.new_index(spark))
    assert found[(1, 1, 4, True)] == 1 and found[(1, 1, 4, False)] == 3
    assert found[(None, None, 2, True)] == 1 and found[(None, None, 2, False)] == 1
    assert found[(0, 0, 2, True)] == 1


def test_ties_on_the_id_are_broken_by_the_other_columns(spark, documents):
    df = documents([(1, "x", "en", "a"), (1, "x", "en", "b"), (1, "x", "en", "c")])
    first = [r["source"] for r in exact.deduplicated(df, queries.new_index(spark), "b").where("kept").collect()]
    again = [r["source"] for r in exact.deduplicated(df.orderBy(F.desc("source")), queries.new_index(spark), "b").where("kept").collect()]
    assert len(first) == 1 and first == again


def test_later_batches_meet_the_index(spark, documents, odd_texts):
    index = queries.new_index(spark)
    assert sum(n for (*_, kept), n in fates(documents([(1, "x"), (2, "y")]), index, "one").items() if kept) == 2
    second = documents([(9, "x"), (10, "z"), (11, "z")])
    wanted = collections.Counter({(9, 1, 1, False): 1, (10, 11, 2, False): 1, (11, 11, 2, True): 1})
    assert fates(second, index, "two") == wanted
    assert fates(second, index, "two") == wanted  # run again after a failure
    assert index.rows().count() == 3
    texts = documents(list(enumerate(odd_texts, 100)))
    assert sum(n for (*_, kept), n in fates(texts, index, "three").items() if kept) == len({t or "" for t in odd_texts})


def test_index_is_bucketed_and_not_shuffled(spark, documents):
    index = queries.new_index(spark)
    exact.deduplicated(documents([(i, f"t{i}") for i in range(50)]), index, "one")
    detail = {row["col_name"]: row["data_type"] for row in spark.sql(f"describe extended {index.name}").collect()}
    assert detail["Num Buckets"] == str(exact.BUCKETS)
    assert "text_sha256" in detail["Bucket Columns"] and "text_sha256" in detail["Sort Columns"]
    groups = documents([(1, "q")]).select(exact.digest_of("text").alias(exact.DIGEST)).groupBy(exact.DIGEST).agg(F.count("*").alias("n"))
    plan = groups.hint("merge").join(index.rows().select(exact.DIGEST), exact.DIGEST, "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    right = text[text.index("SortMergeJoin") :].rpartition("Sort [")[2]
    assert "Exchange" not in right


def test_empty_table_and_clashing_columns(spark, documents):
    assert exact.deduplicated(documents([]), queries.new_index(spark), "b").count() == 0
    df = documents([(1, "x"), (2, "x")], group_size=F.lit("old"), Kept=F.lit(1), note=F.lit("n"))
    rows = exact.deduplicated(df, queries.new_index(spark), "b").collect()
    assert sorted((r["doc_id"], r["group_size"], r["kept"], r["note"]) for r in rows) == [(1, 2, False, "n"), (2, 2, True, "n")]


def test_the_second_half_meets_the_first_in_the_index(spark, documents, monkeypatch):
    rows = [(i, f"t{i % 13}") for i in range(60)] + [(None, "t1"), (None, "alone"), (3, "t3"), (3, "t3"), (70, None), (1, "")]
    seen = []
    unknown = exact.DigestIndex.unknown
    monkeypatch.setattr(exact.DigestIndex, "unknown", lambda self, groups: seen.append(unknown(self, groups)) or seen[-1])
    index = queries.new_index(spark)
    found = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.largest_stays(documents(rows), index).collect())
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    keeper = {text: max(ids, key=lambda i: (i is not None, i)) for text, ids in groups.items()}
    assert collections.Counter((doc, keep, n) for doc, keep, n, _ in found.elements()) == collections.Counter(
        (doc, keeper[text or ""], len(groups[text or ""])) for doc, text in rows
    )
    assert sum(n for (*_, kept), n in found.items() if kept) == len(groups)
    assert all(doc == keep for doc, keep, _, kept in found if kept)
    assert index.rows().count() == len(groups)
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert {row["batch"] for row in index.rows().collect()} == {"larger ids", "other ids"}


def test_the_query_leaves_nothing_behind(spark, smallest):
    before = {table.name for table in spark.catalog.listTables()}
    fates = queries.QUERIES["op7_exact_dedup"](spark, smallest)
    assert {table.name for table in spark.catalog.listTables()} == before
    assert fates.where("kept").count() == fates.select("text_sha256").distinct().count()


def test_kept_rows_are_those_that_stay(spark, documents):
    rows = [(i, f"t{i % 13}") for i in range(60)] + [(None, "t1"), (None, "alone"), (None, "alone"), (3, "t3"), (3, "t3"), (70, None), (1, "")]
    rows += [(90, "same", "en", "a"), (90, "same", "en", "b"), (90, "same", "en", "b"), (2, "same")]
    df = documents(rows, TEXT_SHA256=F.lit("old"), keeper=F.lit(1), note=F.lit("n"))
    index = queries.new_index(spark)
    kept = exact.kept_rows(df, index).collect()
    judged = exact.largest_stays(df, queries.new_index(spark)).where("kept").collect()
    wanted = sorted((str(r["doc_id"]), r["text"] or "", r["text_sha256"]) for r in judged)
    assert sorted((str(r["doc_id"]), r["text"] or "", r["text_sha256"]) for r in kept) == wanted
    assert len(kept) == index.rows().count() and {row["note"] for row in kept} == {"n"}
    again = exact.kept_rows(df.repartition(5), queries.new_index(spark)).collect()
    assert sorted(map(str, again)) == sorted(map(str, kept))
    assert exact.kept_rows(documents([]), queries.new_index(spark)).count() == 0


def test_kept_texts_are_limited_before_their_shuffle(spark, documents):
    plan = exact.kept_rows(documents([(i, "one text") for i in range(50)]), queries.new_index(spark))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "SortMergeJoin" in text
