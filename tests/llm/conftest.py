import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    """Text of invented words, the same for the same seed."""

    def make(count, seed, alphabet="abcdefghij"):
        dice = random.Random(seed)
        return " ".join("".join(dice.choice(alphabet) for _ in range(dice.randint(2, 6))) for _ in range(count))

    return make


@pytest.fixture(scope="session")
def odd_texts(words):
    """NULL, empty, blank, one word, controls, astral characters, repeats and a very long text."""
    long = words(30_000, 99)
    return [None, "", "   ", "\t\n", "Word", "a\x00b \x0bc", "Zoë 😀😀 naïve ▁ ▁x", "the the the the", long, long, "x" * 20_000]


@pytest.fixture
def documents(spark, tmp_path):
    """A stored documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, partitions=3, schema=SCHEMA, **extra):
        full = [tuple(row) + ("en", "s0")[len(row) - 2 :] + (len(row[1] or ""),) for row in rows]
        df = spark.createDataFrame(full, schema)
        for name, column in extra.items():
            df = df.withColumn(name, column)
        path = str(tmp_path / f"documents{random.random()}.parquet")
        df.repartition(partitions).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def speech(words):
    """Text over the vocabulary of one of two languages."""
    vocabulary = {name: words(80, name, letters * 2 + "aeiou").split() for name, letters in (("aa", "bcdfgh"), ("bb", "vwxyz"))}

    def make(name, count, seed):
        dice = random.Random(seed)
        return " ".join(dice.choice(vocabulary[name]) for _ in range(count))

    return make
