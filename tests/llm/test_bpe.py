"""Byte-pair encoding against the library, and the way back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from candlemill.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    ranks = {entry: rank for rank, entry in enumerate(bpe.read_ranks(queries.RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def replay():
    return bpe.Replay(bpe.read_ranks(queries.RANKS))


PATTERN = regex.compile(public_tokenizers.PATTERN)


def test_random_texts(library, replay):
    dice = random.Random(4)
    letters = list("aaaab  \n\t'ésßЖ中😀1290.,!?-_ABCtheing\x1c\x85\xa0 ") + [chr(dice.randrange(32, 0x3000)) for _ in range(80)]
    texts = ["".join(dice.choice(letters) for _ in range(dice.randrange(200))) for _ in range(1500)]
    texts += ["a" * 5000, " " * 3000, "ab" * 4000, "", "\n" * 99, "the" * 999, "<|endoftext|>", "I'm we'LL it's"]
    found = replay.encode(texts, PATTERN)
    assert [ids.tolist() for ids in found] == [library.encode_ordinary(text) for text in texts]
    assert [replay.decode(ids) for ids in found] == [text.encode() for text in texts]


def test_a_small_vocabulary_where_order_matters():
    entries = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"cc", b"abcabc", b"aa", b"aaa"]
    ranks = {entry: rank for rank, entry in enumerate(entries)}
    library = tiktoken.Encoding("tiny", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    dice = random.Random(8)
    texts = ["".join(dice.choice("aabc ") for _ in range(dice.randrange(30))) for _ in range(2000)]
    found = bpe.Replay(entries).encode(texts, regex.compile(r"\S+|\s+"))
    assert [ids.tolist() for ids in found] == [library.encode_ordinary(text) for text in texts]


@pytest.mark.parametrize("size", [1, 7, 100])
def test_parts_change_nothing(library, replay, size):
    dice = random.Random(size)
    for _ in range(50):
        text = "".join(dice.choice("ab  \n\t'.1é") for _ in range(300))
        parts = list(bpe.parts_of(text, size))
        assert "".join(parts) == text
        assert np.concatenate(replay.encode(parts, PATTERN)).tolist() == library.encode_ordinary(text)


def test_odd_texts_and_clashing_columns(documents, odd_texts, library):
    df = documents(list(enumerate(odd_texts)) + [(0, None)], n_tokens=F.lit("old"), note=F.lit("n"))
    done = bpe.decoded(bpe.encoded(df, queries.RANKS, public_tokenizers.PATTERN, corpus_bytes=1000), queries.RANKS)
    for row in done.collect():
        text = row["text"] or ""
        assert row["token_ids"] == library.encode_ordinary(text) and row["n_tokens"] == len(row["token_ids"])
        assert (bytes(row["decoded"]), row["note"]) == (text.encode(), "n")
    assert bpe.encoded(documents([]), queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_query(spark, smallest, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    found = queries.QUERIES["op8_byte_bpe"](spark, smallest).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_words_are_merged_once_per_corpus(library, monkeypatch):
    dice = random.Random(12)
    vocabulary = ["".join(dice.choice("abcdeé") for _ in range(dice.randrange(1, 9))) for _ in range(300)]
    loads = [[" ".join(dice.choice(vocabulary) for _ in range(80)) for _ in range(5)] for _ in range(12)]
    for known, most in ((1 << 20, 1), (200, 12)):
        replay, merged = bpe.Replay(bpe.read_ranks(queries.RANKS), known), []
        encode_words = replay.encode_words
        replay.encode_words = lambda words: merged.append(words) or encode_words(words)
        for texts in loads:
            assert [ids.tolist() for ids in replay.encode(texts, PATTERN)] == [library.encode_ordinary(text) for text in texts]
        times = max(sum(word in words for words in merged) for word in set(sum(merged, [])))
        assert times <= most and (known > 200 or times > 1)
