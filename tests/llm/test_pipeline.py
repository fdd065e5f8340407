"""The stages on a small fixture, against plain Python."""

import collections
import hashlib
import os

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from candlemill.llm import bpe, queries
from candlemill.workspace import shared_root, written
from llm_brute import brute_groups, brute_print


@pytest.fixture
def corpus(documents, speech):
    rows = [(i, speech("aa", 60, i), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, speech("bb", 60, 500 + i), "xx", "s1") for i in range(20)]
    rows += [(200 + i, rows[i][1], "en", "s0") for i in range(10)]  # copies
    base = speech("aa", 400, 77)
    rows += [(300 + i, f"{base} {w}", "en", None) for i, w in enumerate(["one", "two", "six"])]  # near copies
    rows += [(400, "", "en", "s0"), (401, None, None, None), (402, "12 34 !!", "en", "s2"), (403, speech("aa", 50, 900), None, "s2")]
    return documents(rows)


def stage(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, "")


def test_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID",
        "exact dedup",
        "SimHash near-dedup",
        "mixing sources to target weights",
        "byte-level BPE encoding and decoding",
    ]


def test_language(spark, corpus):
    kept = stage(spark, "language ID", corpus)
    assert kept.columns == corpus.columns
    rows = {row["doc_id"]: row["lang"] for row in kept.collect()}
    assert set(rows) == {row["doc_id"] for row in corpus.collect()} - {400, 401, 402}
    assert rows[403] == "en"


def test_copies(spark, corpus):
    kept = stage(spark, "exact dedup", corpus)
    largest = {}
    for row in corpus.collect():
        text = row["text"] or ""
        largest[text] = max(largest.get(text, -1), row["doc_id"])
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(largest.values())
    assert kept.columns == corpus.columns


def test_near_copies(spark, corpus):
    rows = corpus.collect()
    groups = brute_groups([brute_print(row["text"]) for row in rows], 2)
    least = collections.defaultdict(list)
    for row, group in zip(rows, groups):
        least[group].append(row["doc_id"])
    kept = stage(spark, "SimHash near-dedup", corpus)
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(min(ids) for ids in least.values())
    assert kept.columns == corpus.columns


def test_mix(spark, corpus):
    mix = stage(spark, "mixing sources to target weights", corpus)
    assert mix.columns == corpus.columns
    size = collections.Counter()
    for row in corpus.collect():
        size[row["doc_id"]] = len((row["text"] or "").split())
    taken = sum(len(row["text"].split()) for row in mix.collect())
    assert taken == pytest.approx(1.5 * sum(size.values()), abs=len({row["source"] for row in corpus.collect()}))
    assert all(row["n_chars"] == len(row["text"]) for row in mix.collect())
    assert max(collections.Counter(row["doc_id"] for row in mix.collect()).values()) <= 2


def test_tokens(spark, corpus):
    ranks = {entry: rank for rank, entry in enumerate(bpe.read_ranks(queries.RANKS))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {row["doc_id"]: row["text"] or "" for row in corpus.collect()}
    for row in stage(spark, "byte-level BPE encoding and decoding", corpus).collect():
        assert row["token_ids"] == library.encode_ordinary(texts[row["doc_id"]])


def test_tokens_decode_to_the_text(spark, corpus):
    texts = {row["doc_id"]: (row["text"] or "").encode() for row in corpus.collect()}
    found = stage(spark, "byte-level BPE encoding and decoding", corpus).collect()
    assert len(found) == corpus.count()
    for row in found:
        text = texts[row["doc_id"]]
        assert (row["n_bytes"], row["decoded_sha256"]) == (len(text), hashlib.sha256(text).hexdigest())


def test_run(spark, smallest):
    found = corpus_pipeline.run(spark, smallest)
    rows = found.collect()
    assert rows and all(row["n_tokens"] == len(row["token_ids"]) > 0 for row in rows)


def test_empty_documents(spark, documents):
    docs = documents([])
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, "")
        assert docs.count() == 0


def test_extra_and_clashing_columns_go(spark, documents, speech):
    rows = [(i, speech("aa", 40, i % 7), "en", "s") for i in range(30)] + [(40, None, None, None), (None, speech("bb", 30, 3), "xx", None)]
    names = ["lang_pred", "kept", "KEEP_ID", "fingerprint", "positions", "Size", "token_ids", "n_tokens"]
    docs = documents(rows, **{name: F.lit("old") for name in names})
    plain, wide = documents(rows), docs
    for name, function in corpus_pipeline.STAGES:
        plain, wide = function(spark, plain, ""), function(spark, wide, "")
        assert wide.columns == plain.columns
        assert collections.Counter(map(str, wide.collect())) == collections.Counter(map(str, plain.collect())), name
        plain, wide = (written(df, "stage") for df in (plain, wide))


def test_nothing_is_left_behind_but_the_result(spark, smallest):
    root = shared_root(spark).removeprefix("file:")
    before, tables = set(os.listdir(root)), {table.name for table in spark.catalog.listTables()}
    found = corpus_pipeline.run(spark, smallest)
    left = {name for name in set(os.listdir(root)) - before if "-" in name and name.split("-")[0].isalpha()}
    assert len(left) == 1 and found.count() > 0
    assert {table.name for table in spark.catalog.listTables()} == tables
