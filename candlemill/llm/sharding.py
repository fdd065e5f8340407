"""Reproducible shuffling into shards by a permutation of row numbers.

Rows are numbered 0 .. n-1, the number goes through a keyed Feistel permutation
of 0 .. n-1, and the image gives the place: shard = image mod shards, slot =
image div shards.  Shards therefore differ by one row at most, their slots have
no gaps, and where a row number lies can be computed without any table, as can
the row number behind a place.

The permutation works on pairs (left, right) below (a, b) with a*b just above n.
Each round adds a keyed hash of one half to the other half, which is invertible
whatever the hash; an image of n or more is permuted again until it falls below
n (cycle walking).  Fewer than a images are out of range, so one walk rarely
takes a second step.

Numbering needs no global sort: rows are dealt to blocks by a hash of their
content, blocks are counted, and a row's number is its block's offset plus its
rank in the block.  Only rows equal in id and text share a hash, so a hot id or
a hot text is spread over blocks.

Defined results: a NULL text has size 1 and the checksum of the empty text; NULL
ids count as a value of their own; rows equal in id and text get neighbouring
numbers in any order; an empty table gives no rows.  Groups of equal texts are
not kept together, as the law is ``rows``.  Further columns are kept, clashing
names give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import whole_text, with_columns

#: Rows of a block that rows are numbered in, and the least and most blocks; the table of their
#: offsets has no more rows than that, so it may go to every task.
BLOCK_ROWS = 50_000
BLOCKS, MOST_BLOCKS = 4096, 1 << 20
ROUNDS = 6
#: Walks are far shorter; a longer one raises an error instead of a wrong place.
MOST_WALKS = 48


def blocks_for(rows: int) -> int:
    """Blocks that so many rows are numbered in."""
    return min(MOST_BLOCKS, max(BLOCKS, -(-rows // BLOCK_ROWS)))


def numbered(df: DataFrame, keys: list[Column], blocks: int | None = None) -> DataFrame:
    """``df`` with ``_llm_number`` from 0 without gaps, and ``_llm_rows``, their count."""
    blocks = blocks or blocks_for(df.count())
    rows = with_columns(df, {"_llm_hash": F.xxhash64(*keys)}).withColumn(
        "_llm_block", F.pmod("_llm_hash", F.lit(blocks)).cast("int")
    )
    in_order = Window.orderBy("_llm_block")
    offsets = (
        rows.groupBy("_llm_block")
        .agg(F.count("*").alias("_llm_size"))
        .select(
            "_llm_block",
            (F.sum("_llm_size").over(in_order) - F.col("_llm_size")).alias("_llm_before"),
            F.sum("_llm_size")
            .over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("_llm_rows"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("_llm_block").orderBy("_llm_hash", *keys))
    return (
        rows.withColumn("_llm_rank", rank)
        .join(F.broadcast(offsets), "_llm_block")  # at most ``blocks`` rows
        .withColumn("_llm_number", F.col("_llm_before") + F.col("_llm_rank") - 1)
        .drop("_llm_hash", "_llm_block", "_llm_rank", "_llm_before")
    )


def _sides(n: Column) -> tuple[Column, Column]:
    """a and b with a*b >= n and a*b - n < a."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    return a, _quotient(n + a - 1, a)


def _quotient(x: Column, y: Column | int) -> Column:
    return ((x - x % y) / y).cast("long")


def _round(number: int, seed: int, half: Column) -> Column:
    return F.xxhash64(half, F.lit(seed), F.lit(number))


def _forward(x: Column, n: Column, seed: int) -> Column:
    a, b = _sides(n)
    halves = F.struct((x % a).alias("l"), _quotient(x, a).alias("r"))
    for number in range(ROUNDS):
        halves = _mixed(halves, a, b, number, seed, 1)
    return _through(halves, lambda pair: pair["r"] * a + pair["l"])


def _backward(x: Column, n: Column, seed: int) -> Column:
    a, b = _sides(n)
    halves = F.struct((x % a).alias("l"), _quotient(x, a).alias("r"))
    for number in reversed(range(ROUNDS)):
        halves = _mixed(halves, a, b, number, seed, -1)
    return _through(halves, lambda pair: pair["r"] * a + pair["l"])


def _through(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _mixed(halves: Column, a: Column, b: Column, number: int, seed: int, sign: int) -> Column:
    if number % 2:
        return _through(
            halves,
            lambda p: F.struct(p["l"].alias("l"), F.pmod(p["r"] + sign * F.pmod(_round(number, seed, p["l"]), b), b).alias("r")),
        )
    return _through(
        halves,
        lambda p: F.struct(F.pmod(p["l"] + sign * F.pmod(_round(number, seed, p["r"]), a), a).alias("l"), p["r"].alias("r")),
    )


def _walked(x: Column, n: Column, seed: int, step) -> Column:
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_WALKS)),
        step(x, n, seed),
        lambda at, _: F.when(at < n, at).otherwise(step(at, n, seed)),
    )
    return _through(walked, lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("the walk was too long")).cast("long")))


def permuted(number: Column, n: Column, seed: int) -> Column:
    """The image of ``number`` under the keyed permutation of 0 .. n-1."""
    return _walked(number, n, seed, _forward)


def number_at(shard: Column, slot: Column, shards: int, n: Column, seed: int) -> Column:
    """The row number that lies at a place: the inverse of ``sharded``."""
    return _walked(slot * shards + shard, n, seed, _backward)


def sharded(df: DataFrame, shards: int, seed: int = 2025, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``law``, ``number``, ``shard``, ``slot`` and ``grown_shard``."""
    rows = with_columns(
        df,
        {
            "size": F.octet_length(whole_text(text)).cast("long") + 1,
            "text_crc32": F.crc32(whole_text(text).cast("binary")),
            "_llm_text": F.xxhash64(whole_text(text)),
        },
    )
    keys = [F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("NULL")), F.col("_llm_text"), F.col("text_crc32")]
    placed = numbered(rows, keys).withColumn("_llm_image", permuted(F.col("_llm_number"), F.col("_llm_rows"), seed))
    return with_columns(
        placed,
        {
            "law": F.lit("rows"),
            "number": F.col("_llm_number"),
            "shard": (F.col("_llm_image") % shards).cast("int"),
            "slot": _quotient(F.col("_llm_image"), shards),
            "grown_shard": F.lit(None).cast("int"),
        },
    ).drop("_llm_text", "_llm_number", "_llm_rows", "_llm_image")
