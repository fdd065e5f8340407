"""The permutation, its inverse, and places without gaps."""

import collections
import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from candlemill.llm import queries, sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 1000, 4097])
def test_permutation_and_inverse(spark, n):
    size = F.lit(n).cast("long")
    image = sharding.permuted(F.col("id"), size, 11)
    rows = spark.range(n).select("id", image.alias("image"))
    back = rows.withColumn("shard", F.col("image") % 16).withColumn("slot", ((F.col("image") - F.col("shard")) / 16).cast("long"))
    found = back.select("id", "image", sharding.number_at(F.col("shard"), F.col("slot"), 16, size, 11).alias("back")).collect()
    assert sorted(row["image"] for row in found) == list(range(n))
    assert all(row["id"] == row["back"] for row in found)
    if n >= 100:
        assert sum(row["id"] == row["image"] for row in found) < n / 10


def check(found, shards):
    slots = collections.defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
    sizes = [len(slots[shard]) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(of) == list(range(len(of))) for of in slots.values())


def test_odd_rows(documents, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, None), (None, None), (3, "same"), (3, "same"), (4, "same")]
    df = documents(rows, shard=F.lit("old"), SIZE=F.lit(1), note=F.lit("n"))
    found = sharding.sharded(df, 4).collect()
    assert len(found) == len(rows)
    check(found, 4)
    for row in found:
        text = (row["text"] or "").encode()
        assert (row["size"], row["text_crc32"], row["note"]) == (len(text) + 1, zlib.crc32(text), "n")
        assert row["law"] == "rows" and row["grown_shard"] is None


def test_same_places_however_the_table_is_cut(documents, words):
    rows = [(i, words(5, i)) for i in range(300)]
    one, two = (
        {row["doc_id"]: (row["shard"], row["slot"]) for row in sharding.sharded(documents(rows, parts), 16).collect()}
        for parts in (1, 9)
    )
    assert one == two


def test_place_is_computable_from_the_number(documents, words):
    found = sharding.sharded(documents([(i, words(3, i)) for i in range(77)]), 8, seed=5)
    n = F.lit(77).cast("long")
    back = sharding.number_at(F.col("shard").cast("long"), F.col("slot"), 8, n, 5)
    assert found.where(back != F.col("number")).count() == 0


def test_empty_table(documents):
    assert sharding.sharded(documents([]), 16).count() == 0


def test_query(spark, sf_dir):
    found = queries.QUERIES["op5_feistel_shards"](spark, sf_dir).collect()
    check(found, 16)
    assert sorted(row["number"] for row in found) == list(range(len(found)))


def xx(*values, seed=42):
    """Spark's xxhash64 of texts, 64-bit and (as a 1-tuple) 32-bit numbers: each value is seeded with the last hash."""
    for value in values:
        data = value.encode() if isinstance(value, str) else struct.pack("<i", *value) if isinstance(value, tuple) else struct.pack("<q", value)
        seed = xxhash.xxh64_intdigest(data, seed % 2**64)
    return seed - 2**64 if seed >= 2**63 else seed


def placed(rows, shards, seed=2025, blocks=sharding.BLOCKS):
    """(doc_id, crc, number, shard, slot) of each row, one number and one walk at a time."""
    keyed = []
    for doc, text in rows:
        keys = ("NULL" if doc is None else str(doc), xx(text or ""), zlib.crc32((text or "").encode()))
        keyed.append((xx(*keys) % blocks, xx(*keys), keys, doc))
    n, found = len(rows), []
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    for number, (_, _, keys, doc) in enumerate(sorted(keyed, key=lambda row: row[:3])):
        image = number
        while True:
            left, right = image % a, image // a
            for turn in range(sharding.ROUNDS):
                if turn % 2:
                    right = (right + xx(left, (seed,), (turn,)) % b) % b
                else:
                    left = (left + xx(right, (seed,), (turn,)) % a) % a
            image = right * a + left
            if image < n:
                break
        found.append((doc, keys[2], number, image % shards, image // shards))
    return collections.Counter(found)


def test_places_against_a_plain_walk(spark, documents, odd_texts, smallest):
    rows = list(enumerate(odd_texts)) + [(i, f"text {i % 50}") for i in range(20, 400)] + [(None, "x"), (None, None), (7, "x"), (7, "x")]
    found = sharding.sharded(documents(rows), 5, seed=9).select("doc_id", "text_crc32", "number", "shard", "slot").collect()
    assert collections.Counter(map(tuple, found)) == placed(rows, 5, 9)
    rows = [tuple(r) for r in spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op5_feistel_shards"](spark, smallest).select("doc_id", "text_crc32", "number", "shard", "slot").collect()
    assert collections.Counter(map(tuple, found)) == placed(rows, 16)


def test_blocks_follow_the_rows():
    assert sharding.blocks_for(10) == sharding.blocks_for(100_000_000) == sharding.BLOCKS
    assert sharding.blocks_for(10**9) == 20_000 and sharding.blocks_for(10**15) == sharding.MOST_BLOCKS
