"""Token counts against the library on whole texts."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from candlemill.llm import queries, token_counts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)


def test_odd_texts(documents, odd_texts, library):
    texts = [*odd_texts, "<s> </s> <unk>", " lead", "trail ", "a  b", "▁ ▁", "tab\tline\n"]
    rows = token_counts.count_tokens(documents(list(enumerate(texts))), queries.MODEL, limit=5).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        n = len(library.encode(text))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 5)


@pytest.mark.parametrize("size", [1, 3, 10, 50])
def test_cuts_change_no_count(library, size):
    dice = random.Random(size)
    for _ in range(300):
        text = "".join(dice.choice("ab  ▁\té.😀 the") for _ in range(dice.randint(0, 60)))
        pieces = token_counts.cut(text, size)
        assert sum(len(ids) for ids in library.encode(pieces)) == len(library.encode(text)), repr(text)


def test_batches_change_no_count(documents, words, library):
    rows = [(i, words(i * 7, i)) for i in range(40)]
    found = token_counts.count_tokens(documents(rows), queries.MODEL, piece_chars=20, batch_bytes=100).collect()
    assert {row["doc_id"]: row["n_tokens"] for row in found} == {i: len(library.encode(text)) for i, text in rows}


def test_clashing_columns_repeated_rows_and_empty_table(documents):
    df = documents([(1, "a b"), (1, "a b"), (None, None)], n_tokens=F.lit("old"), Over_Limit=F.lit(3))
    rows = token_counts.count_tokens(df, queries.MODEL).collect()
    assert sorted(row["n_tokens"] for row in rows) == [0, 2, 2]
    assert rows[0]["over_limit"] is False
    assert token_counts.count_tokens(documents([]), queries.MODEL).count() == 0


def test_query(spark, smallest, library):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_token_counts"](spark, smallest).collect()
    assert {row["doc_id"]: row["n_tokens"] for row in rows} == {i: len(library.encode(t or "")) for i, t in texts.items()}
