"""Fill-in-the-middle against the definition, and the way back."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlemill.llm import infilling, queries


def brute(doc_id, text, seed=7, rate=100, spm=50):
    """(n, form, prefix_chars, middle_chars, output) of a text."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, chance, turn = (int(digits[at : at + 8], 16) for at in (0, 8, 16, 24))
    a, b = sorted((one % (len(lines) + 1), two % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in infilling.MARKERS) or chance % 100 >= rate:
        return len(lines), "plain", None, None, text
    if turn % 100 < spm:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def many():
    """Texts of shared passages, short and endless lines, and characters of one to four bytes."""
    dice = random.Random(3)
    passages = ["".join(dice.choice("ab é中😀.\n") for _ in range(dice.randrange(1, 4000))) for _ in range(12)]
    texts = ["".join(dice.choice(passages) for _ in range(dice.randrange(5))) for _ in range(150)]
    texts += ["\n", "\n\n", "a", "a\n", "\na", "é\r\né\x0b\x85 é", "x" * 50_000, "x\n" * 30_000, "<P>", "a<M>b", "<<P", "<P<S<M", "<S" * 9, "a<\n<P\n>"]
    return texts


def test_definition(documents, many):
    rows = list(enumerate(many))
    done = infilling.fill_in_middle(documents(rows)).withColumn("back", infilling.restored(F.col("output"), F.col("form")))
    found = done.collect()
    assert len(found) == len(rows)
    for row in found:
        assert tuple(row[name] for name in ("n", "form", "prefix_chars", "middle_chars", "output")) == brute(row["doc_id"], row["text"])
        assert row["back"] == row["text"]
    assert {row["form"] for row in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize(("rate", "spm"), [(0, 50), (60, 0), (60, 100), (100, 30)])
def test_rates(documents, many, rate, spm):
    done = infilling.fill_in_middle(documents(list(enumerate(many))), seed=3, rate=rate, spm=spm)
    for row in done.collect():
        assert (row["form"], row["output"]) == tuple(brute(row["doc_id"], row["text"], 3, rate, spm)[at] for at in (1, 4))


def test_odd_texts_and_clashing_columns(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "a\nb\nc"), (4, "Word"), (4, "Word")]
    found = infilling.fill_in_middle(documents(rows, N=F.lit("old"), Output=F.lit(1), note=F.lit("x")), cache_bytes=1000).collect()
    assert len(found) == len(rows) and {row["note"] for row in found} == {"x"}
    for row in found:
        assert (row["n"], row["output"]) == tuple(brute(row["doc_id"], row["text"])[at] for at in (0, 4))
    assert infilling.fill_in_middle(documents([])).count() == 0


def test_shared_passages_share_chunks(many):
    passage = many[0] + many[1] + "".join(chr(97 + i % 23 * i % 7) for i in range(5000))
    texts = [passage, "other beginning\n" * 9 + passage]
    (one, first), (two, second) = infilling.chunked(pa.array(texts))
    assert (b"".join(first), b"".join(second)) == (one, two) == tuple(text.encode() for text in texts)
    assert len(first) > 20 and first[4:] == second[4 - len(first) :]
    assert all(len(chunk) <= infilling.MOST for chunk in first)


def test_summaries_stay_within_their_bytes():
    summaries = infilling.Summaries(most=1000)
    for number in range(500):
        chunk = f"{number}\n".encode() * 20
        assert summaries.of(chunk) == summaries.of(chunk) == (
            [at + 1 for at, byte in enumerate(chunk) if byte == 10], len(chunk))
        assert sum(map(len, summaries.young)) + sum(map(len, summaries.old)) <= 1000 + len(chunk)


def test_query(spark, smallest):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    found = queries.QUERIES["op11_infilling"](spark, smallest).collect()
    assert len(found) == len(texts)
    for row in found:
        *plain, output = brute(row["doc_id"], texts[row["doc_id"]])
        assert list(row)[1:5] == plain
        assert row["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert row["restored_sha256"] == hashlib.sha256((texts[row["doc_id"]] or "").encode()).hexdigest()
