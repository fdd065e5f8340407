"""Runs against a comparison of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlemill.llm import periodic, queries


def brute(words, least=6, exponent=4):
    """(start, length, period) by start and period: each stretch with its smallest period."""
    found = {}
    for period in range(1, len(words) // exponent + 1):
        start = 0
        while start < len(words) - period:
            stop = start
            while stop < len(words) - period and words[stop] == words[stop + period]:
                stop += 1
            if stop > start and stop + period - start >= max(least, exponent * period):
                found.setdefault((start, stop + period - start), period)
            start = stop + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def loops(dice, letters="abcdefgh"):
    parts = []
    for _ in range(dice.randrange(6)):
        few = letters[: dice.choice([1, 2, 8])]
        piece = [dice.choice(few) for _ in range(dice.randrange(1, 50))]
        parts += piece * dice.randrange(1, 9) + piece[: dice.randrange(len(piece) + 1)] if dice.random() < 0.6 else piece
    return parts


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (6, 3), (9, 5), (3, 2)])
def test_all_runs(least, exponent):
    dice = random.Random(least * 10 + exponent)
    for _ in range(150):
        texts = [loops(dice) for _ in range(dice.randrange(1, 9))]
        texts += texts[:2]
        load = periodic.Load([" ".join(words).encode() for words in texts])
        wanted = [(start + int(at), n, q) for at, words in zip(load.starts, texts) for start, n, q in brute(words, least, exponent)]
        assert [tuple(run) for run in load.runs(least, exponent).tolist()] == wanted


def test_extensions():
    dice = np.random.default_rng(2)
    for size in (1, 2, 40, 700):
        words = np.concatenate([dice.integers(0, 2, size), np.tile(dice.integers(0, 3, 45), 6), [9]])
        pairs = dice.integers(0, len(words), (500, 2))
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        found = periodic.Extensions(words).lengths(pairs[:, 0], pairs[:, 1])
        for (a, b), n in zip(pairs.tolist(), found.tolist()):
            tail = words[max(a, b) :]
            differs = np.flatnonzero(tail != words[min(a, b) :][: len(tail)])
            assert n == (differs[0] if len(differs) else len(tail))


def test_cover_reaches_every_difference():
    for difference in range(periodic.MODULUS):
        a = periodic.Extensions._TARGET[difference]
        assert a in periodic.COVER and (a + difference) % periodic.MODULUS in periodic.COVER


def test_small_blocks_change_nothing(monkeypatch):
    dice = random.Random(9)
    load = periodic.Load([" ".join(loops(dice)).encode() for _ in range(30)])
    whole = load.runs(6, 4).tolist()
    monkeypatch.setattr(periodic, "BLOCK", 7)
    assert load.runs(6, 4).tolist() == whole != []


def test_odd_texts_and_clashing_columns(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(50, "a b " * 40 + "c"), (50, "a b " * 40 + "c"), (None, "z " * 5), (51, "w " * 20_000)]
    df = documents(rows, RUNS=F.lit("old"), collapsed=F.lit(1), note=F.lit("n"))
    found = periodic.periodic_runs(df).collect()
    assert len(found) == len(rows)
    for row in found:
        words = [word.decode() for word in (row["text"] or "").encode().split()]
        runs = [(0, 20_000, 1)] if row["doc_id"] == 51 else brute(words) if len(words) < 1000 else [tuple(run) for run in row["runs"]]
        assert [tuple(run) for run in row["runs"]] == runs
        assert (row["collapsed"], row["note"]) == (brute_collapsed(words, runs), "n")
    assert periodic.periodic_runs(documents([])).count() == 0


def test_a_long_text_with_a_long_period(words):
    piece = words(7000, 3)
    text = " ".join([words(100, 4), *[piece] * 4, piece[:50]]).encode()
    runs = periodic.Load([text]).runs(6, 4)
    assert [7000] == [period for _, _, period in runs.tolist() if period > 100]


def test_bounds_of_the_parameters(documents):
    with pytest.raises(ValueError):
        periodic.periodic_runs(documents([]), exponent=1)


def test_query(spark, smallest):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    found = queries.QUERIES["op13_periodic_runs"](spark, smallest).collect()
    assert len(found) == len(texts)
    looped = 0
    for row in found:
        words = [word.decode() for word in texts[row["doc_id"]].encode().split()]
        h = zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n, original = h // 10, len(words), list(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
        runs = brute(words) if len(words) < 3000 else [tuple(run) for run in periodic.Load([" ".join(words).encode()]).runs(6, 4) - [1, 0, 0]]
        looped += bool(runs)
        assert row["n_runs"] == len(runs)
        longest = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None,) * 3
        assert (row["start"], row["length"], row["period"]) == longest
        assert row["exponent_milli"] == (1000 * longest[1] // longest[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert looped > 10
