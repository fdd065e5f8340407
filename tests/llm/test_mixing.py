"""The mix: targets, words taken, positions."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from candlemill.llm import mixing


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by filling up step by step."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[at % len(weights)] for at, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        even = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if cap * sizes[s] < even * weight[s]}
        if not over:
            target |= {s: even * weight[s] for s in open_}
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def rows_of(words):
    counts = {"a": 60, "b": 5, "c": 20, None: 10, "é": 3, "Z": 30}
    rows, number = [], 0
    for source, count in counts.items():
        for i in range(count):
            rows.append((number, words(1 + (number * 7) % 50, number), "en", source))
            number += 1
    return rows


def test_targets_taken_words_and_positions(documents, words):
    rows = rows_of(words)
    found = mixing.assigned(documents(rows)).collect()
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text))
    target = filled(sizes)
    taken = collections.Counter()
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]], rel=1e-12)
        assert 0 <= row["taken"] <= 2 * row["size"]
        assert len(row["positions"]) == -(-row["taken"] // row["size"])
        assert all(0 <= p <= 1 for p in row["positions"])
        assert list(row["positions"]) == sorted(row["positions"])
        taken[row["source"]] += row["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    again = mixing.assigned(documents(rows, partitions=7)).collect()
    assert {r["doc_id"]: tuple(r["positions"]) for r in again} == {r["doc_id"]: tuple(r["positions"]) for r in found}


def test_positions_follow_the_schedule(documents, words):
    """With a rising schedule, half of the words come after the time at which the integral is a half."""
    rows = [(i, words(20, i), "en", "s") for i in range(400)]
    schedule = ((0.0, 0.0), (0.25, 0.5), (1.0, 2.0))
    found = mixing.assigned(documents(rows), schedules=[schedule], share=1.0).select(F.explode("positions").alias("p")).collect()
    whole = 0.25 * 0.25 + 0.75 * 1.25
    for time in (0.1, 0.25, 0.5, 0.9):
        area = time * time if time <= 0.25 else 0.0625 + (time - 0.25) * (0.5 + (0.5 + 2 * (time - 0.25))) / 2
        below = sum(row["p"] <= time for row in found) / len(found)
        assert below == pytest.approx(area / whole, abs=0.01)


def test_curriculum_reads_the_words_that_are_taken(documents, words):
    rows = rows_of(words)
    placed = mixing.assigned(documents(rows)).cache()
    mix = mixing.curriculum(placed, ["doc_id", "source", "text"]).collect()
    read, texts = collections.defaultdict(list), {row[0]: row[1] for row in rows}
    for row in mix:
        read[row["doc_id"]].append(row["text"])
    cut = 0
    for row in placed.collect():
        whole, rest = divmod(row["taken"], max(1, row["size"]))
        found = sorted(read[row["doc_id"]], key=len, reverse=True)
        assert found[:whole] == [texts[row["doc_id"]]] * whole and len(found) == whole + bool(rest)
        if rest:
            assert found[-1] == " ".join(texts[row["doc_id"]].split(" ")[:rest])
        cut += bool(rest)
    assert 0 < cut <= len({row[3] for row in rows})


def test_one_very_long_document_is_read_in_part(documents, words):
    """A source that is one document gets exactly the words of its target, blanks as they are."""
    long = "\n" + words(3000, 5).replace(" ", " \t", 1000) + " "
    rows = [(i, words(10, i), "en", "a") for i in range(300)] + [(900, long, "en", "b")]
    placed = mixing.assigned(documents(rows), share=0.2).cache()
    mix = mixing.curriculum(placed, ["doc_id", "source", "text"]).collect()
    for source in "ab":
        taken = sum(row["taken"] for row in placed.where(F.col("source") == source).collect())
        assert sum(len(row["text"].split()) for row in mix if row["source"] == source) == taken > 0
    (part,) = [row["text"] for row in mix if row["source"] == "b"]
    assert long.startswith(part) and part[-1] not in " \t\n" and len(part) < len(long) / 2


def test_odd_rows(documents, odd_texts):
    rows = [(i, text, None, None if i % 2 else "s") for i, text in enumerate(odd_texts)] + [(None, "a b"), (7, "q r", None, ""), (7, "q r", None, "")]
    df = documents(rows, size=F.lit("old"), TARGET=F.lit(1), note=F.lit("n"))
    found = mixing.assigned(df).collect()
    assert len(found) == len(rows)
    assert all(row["taken"] == 0 and not row["positions"] for row in found if row["size"] == 0)
    assert {row["note"] for row in found} == {"n"}
    mixing.curriculum(mixing.assigned(df), ["doc_id"]).collect()


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "one")]])
def test_tiny_tables(documents, rows):
    found = mixing.assigned(documents(rows)).collect()
    assert sorted((row["doc_id"], row["taken"]) for row in found) == [(i, 2 * bool(text) and round(1.5)) for i, text in rows]
