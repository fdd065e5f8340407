"""Languages by compression: held-out accuracy, rejections, odd rows."""

import collections
import zlib

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from candlemill.llm import language, queries


@pytest.fixture
def dictionaries(speech):
    return {name: language.plain(speech(name, 3000, 1)) for name in ("aa", "bb")}


def test_odd_texts(documents, odd_texts, dictionaries):
    rows = language.identify(documents(list(enumerate(odd_texts + ["123 ..!", "́̂"]))), dictionaries).collect()
    assert len(rows) == len(odd_texts) + 2
    for row in rows:
        text = row["text"] or ""
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text)), repr(text[:20])
        assert 0 <= row["score"] <= 1
        assert row["rejected"] == (row["lang_pred"] == "und" or row["score"] < language.MARGIN)


def test_clear_texts_and_ties(documents, speech, dictionaries):
    df = documents([(1, speech("aa", 20, 5)), (2, speech("bb", 20, 6).upper()), (3, "語"), (4, speech("aa", 5000, 7))])
    found = {row["doc_id"]: row for row in language.identify(df, dictionaries).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["aa", "bb", "aa", "aa"]
    assert found[3]["score"] == 0 and found[3]["rejected"]
    assert not found[4]["rejected"] and found[4]["score"] > 0.1


def test_only_labelled_rows_are_learned_and_copies_count_once(documents, words):
    rows = [(i, words(30, i), "xx" if i % 2 else None, "s") for i in range(20)] + [(99, "same text here", "yy", "s")] * 500
    learned = language.fit(documents(rows))
    assert sorted(learned) == ["xx", "yy"]
    assert learned["yy"].strip() == b"same text here"
    assert len(learned["xx"]) <= language.DICTIONARY_BYTES


def test_one_or_no_language(documents, words):
    df = documents([(1, "some words"), (2, None)])
    assert {(r["lang_pred"], r["score"]) for r in language.identify(df, {}).collect()} == {("und", 0.0)}
    assert sorted((r["lang_pred"], r["score"]) for r in language.identify(df, {"q": b"zz"}).collect()) == [("q", 1.0), ("und", 0.0)]
    assert language.fit(documents([])) == {}
    assert language.identify(documents([]), {}).count() == 0


def test_clashing_columns(documents, dictionaries):
    df = documents([(1, "abc abd"), (1, "abc abd")], Score=F.lit("old"), note=F.lit("n"))
    rows = language.identify(df, dictionaries).collect()
    assert len(rows) == 2 and {row["note"] for row in rows} == {"n"}
    assert all(isinstance(row["score"], float) for row in rows)


def test_held_out_accuracy(spark, sf_dir):
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op6_language"](spark, sf_dir).join(langs, "doc_id").where("held_out")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right >= 0.97


def sampled(rows):
    """A dictionary per language: of its different texts those with the smallest hashes."""
    by_lang = collections.defaultdict(dict)
    for text, lang in rows:
        if text is not None and lang is not None:
            h = xxhash.xxh64_intdigest(text.encode(), 42)
            by_lang[lang][h - 2**64 if h >= 2**63 else h] = text
    found = {}
    for lang, texts in by_lang.items():
        raw = b""
        for h in sorted(texts)[: language.SAMPLE_TEXTS]:
            words = language.plain(texts[h][: language.SAMPLE_CHARS])
            if words:
                raw = (raw + b" " + words[: language.SAMPLE_BYTES])[: language.DICTIONARY_BYTES]
        found[lang] = raw
    return found


def sizes(text, dictionaries):
    """Compressed bytes of a text under each dictionary, one block and one fresh compressor at a time."""
    params = zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=16, chain_log=16, search_log=5, min_match=4, target_length=32,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    words, found = language.plain(text), {}
    for lang, raw in dictionaries.items():
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=params)
        found[lang] = 0
        for at in range(0, len(words), language.BLOCK):
            packed = zstandard.ZstdCompressor(compression_params=params, dict_data=known).compress(words[at : at + language.BLOCK] + language.PADDING)
            found[lang] += len(packed)
    return found


def test_query_against_a_plain_loop(spark, smallest):
    documents = spark.read.parquet(f"{smallest}/documents.parquet").collect()
    learned = sampled([(r["text"], r["lang"]) for r in documents if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2])
    assert learned == queries.learned_languages(spark.read.parquet(f"{smallest}/documents.parquet"))
    found = {row["doc_id"]: row for row in queries.QUERIES["op6_language"](spark, smallest).collect()}
    for row in documents:
        pred, score = "und", 0.0
        if row["text"] and any(c.isalpha() for c in row["text"]):
            first, second = sorted((n, lang) for lang, n in sizes(row["text"], learned).items())[:2]
            pred, score = first[1], 1 - first[0] / second[0]
        assert (found[row["doc_id"]]["lang_pred"], found[row["doc_id"]]["score"]) == (pred, pytest.approx(score, abs=1e-12))


def test_sample_of_a_language_with_many_texts(spark, speech):
    rows = [(speech("aa", 12, i), "aa") for i in range(700)] + [(speech("bb", 12, i), "bb") for i in range(40)] + [(None, "aa"), ("x", None)]
    df = spark.createDataFrame(rows * 2, "text string, lang string").repartition(7)
    assert language.fit(df) == sampled(rows)
