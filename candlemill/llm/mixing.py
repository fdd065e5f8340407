"""Mixing sources to target weights along a curriculum that changes with time.

Each source gets a target of words: its weight's share of the budget, at most
``cap`` times what it has, with the excess reshared by weight until no source is
above its cap.  Within a source the documents stand in a shuffled order that
their content decides, and the source is read through as often as the target
asks, the last time in part.

When a source is read is decided by its weight schedule: a piecewise linear
multiplier over training time 0 .. 1.  Its integral is the share of the source's
words that are demanded up to a time.  A document begins at the time at which
that demand reaches the words that stand before it, so inverting the integral (a
square root in each piece) gives its training position, and sorting all
documents by range of position gives the training order.

Running word counts need no pass over a whole source: the order is cut into
blocks by the leading digits of the hash, blocks are summed on the map side, and
the sums before a block are added to the running count inside it.  A source with
a third of all rows is thereby spread over many groups, whose number follows the row count.

Defined results: a NULL text has no words and is never placed; a NULL source is
a source of its own, last in order.  Rows equal in id and text stand next to
each other in any order, and each takes its own part.  A document that the
budget ends in is taken up to that word.  An empty table gives an empty mix.
Further columns are kept, clashing names give way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import WORD, whole_text, with_columns

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Schedules of the sources, repeating: knots (time, multiplier) from 0 to 1.
#: The first comes in rising, the second is even, the third fades.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
#: Leading digits of the hash that name a block: up to 16 ** 6 blocks a source, as many as hold ``BLOCK_ROWS`` rows.
MOST_DIGITS = 6
BLOCK_ROWS = 50_000


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """``target`` and ``_llm_rank`` (from 0) per row of ``sizes`` (``_llm_source``, ``source_size``).

    One row per source; these few rows are ranked in one task.  A source is capped if,
    with all sources of a smaller cap per weight capped, an even share still exceeds its cap.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("_llm_limit") / F.col("_llm_weight"), "_llm_source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.row_number().over(Window.orderBy("_llm_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_llm_rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("_llm_rank", rank)
        .withColumn("_llm_weight", weight)
        .withColumn("_llm_limit", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_llm_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    left = F.col("_llm_budget") - F.coalesce(F.sum("_llm_limit").over(before), F.lit(0.0))
    weights_left = F.sum("_llm_weight").over(everything) - F.coalesce(F.sum("_llm_weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("_llm_level", left / weights_left)
    fits = F.col("_llm_level") * F.col("_llm_weight") <= F.col("_llm_limit")
    # The level only falls short of a cap from some source on; the first of those sets it for all.
    level = F.min(F.when(fits, F.struct((F.col("_llm_limit") / F.col("_llm_weight")).alias("cap"), "_llm_source", "_llm_level"))).over(everything)
    even = level["_llm_level"] * F.col("_llm_weight")
    return levels.withColumn("target", F.least(F.col("_llm_limit"), F.coalesce(even, F.col("_llm_limit")))).select(
        "_llm_source", "source_size", "target", "_llm_rank"
    )


def time_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of a piecewise linear schedule reaches ``share`` of its whole."""
    pieces = [
        (t0, t1, w0, w1, (t1 - t0) * (w0 + w1) / 2) for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)
    ]
    wanted = share * F.lit(sum(piece[4] for piece in pieces))
    found, done = None, 0.0
    for t0, t1, w0, w1, area in pieces:
        slope = (w1 - w0) / (t1 - t0)
        rest = wanted - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        # A schedule that starts from zero has neither words nor weight there.
        inside = F.least(F.lit(t1), F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(w0) + root), F.lit(0.0)))
        done += area
        here = wanted <= F.lit(done) if t1 < knots[-1][0] else F.lit(True)
        found = F.when(here, inside) if found is None else found.when(here, inside)
    return found


def assigned(
    df: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = 1.5,
    cap: float = 2.0,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``taken`` and ``positions``.

    ``positions`` has the begin of each reading of the document, in [0, 1]; it is
    empty for a document the mix does not take.
    """
    # Sources as text keys that are never NULL: the NULL source sorts last.
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("~"))
    order = F.md5(F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("NULL")), F.lit(":"), whole_text(text)).cast("binary"))
    # One more digit for each sixteenfold of the rows, three at least.
    digits = min(MOST_DIGITS, max(3, math.ceil(math.log(max(1, df.count() / BLOCK_ROWS), 16)) + 1))
    rows = with_columns(
        df,
        {"size": F.regexp_count(whole_text(text), F.lit(WORD)).cast("long"), "_llm_source": key, "_llm_order": order},
    ).withColumn("_llm_block", F.substring("_llm_order", 1, digits))
    rows = rows.drop("source_size", "target")
    blocks = rows.groupBy("_llm_source", "_llm_block").agg(F.sum("size").alias("_llm_words"))
    targets = source_targets(blocks.groupBy("_llm_source").agg(F.sum("_llm_words").alias("source_size")), weights, share, cap)
    in_source = Window.partitionBy("_llm_source").orderBy("_llm_block")
    starts = blocks.select(
        "_llm_source",
        "_llm_block",
        (F.sum("_llm_words").over(in_source) - F.col("_llm_words")).alias("_llm_start"),
    ).join(targets, "_llm_source")
    in_block = Window.partitionBy("_llm_source", "_llm_block").orderBy("_llm_order")
    running = F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = (
        rows.withColumn("_llm_inside", running)
        .join(starts, ["_llm_source", "_llm_block"])
        .withColumn("_llm_before", F.col("_llm_start") + F.col("_llm_inside"))
        .withColumn("_llm_total", F.floor(F.col("target") + 0.5))
        .withColumn("_llm_passes", F.coalesce(F.floor(F.try_divide(F.col("_llm_total"), F.col("source_size"))), F.lit(0)))
    )
    rest = F.col("_llm_total") - F.col("_llm_passes") * F.col("source_size")
    last = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("_llm_before")))
    taken = F.when(F.col("size") > 0, F.col("_llm_passes") * F.col("size") + last).otherwise(0).cast("long")
    readings = F.when(
        F.col("size") > 0, F.col("_llm_passes") + F.when(last > 0, 1).otherwise(0)
    ).otherwise(0)
    shares = F.transform(
        F.sequence(F.lit(1), F.greatest(readings, F.lit(1)).cast("int")),
        lambda n: F.try_divide((n - 1) * F.col("source_size") + F.col("_llm_before"), F.col("_llm_total")),
    )
    schedule = F.col("_llm_rank") % len(schedules)

    def time(y: Column) -> Column:
        found = None
        for at, knots in enumerate(schedules):
            one = time_of(y, knots)
            found = F.when(schedule == at, one) if found is None else found.when(schedule == at, one)
        return found

    positions = F.when(readings > 0, F.transform(shares, time)).otherwise(F.array().cast("array<double>"))
    return with_columns(
        placed,
        {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": taken, "positions": positions},
    ).drop(*[name for name in placed.columns if name.startswith("_llm_") and name not in df.columns])


def head_words(text: Column, words: Column) -> Column:
    """The beginning of a text up to the end of its so many-th word, blanks as they are."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, 1, words), "")


def curriculum(placed: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """The mix in training order: a row for each reading, sorted by ranges of position.

    The last reading of a document that is taken in part ends at the word up to
    which it is taken, so a source's words in the mix are those it was given.
    """
    left = (F.col("taken") - F.col("_llm_reading") * F.col("size")).cast("int")
    # Few rows are cut: a source has one document that its target ends in.
    read = F.when(left < F.col("size"), head_words(F.col(f"`{text}`"), left)).otherwise(F.col(f"`{text}`"))
    kept = [read.alias(name) if name == text else F.col(f"`{name}`") for name in columns]
    return (
        placed.where(F.col("taken") > 0)
        .select("*", F.posexplode("positions").alias("_llm_reading", "_llm_position"))
        .select(*kept, "_llm_position")
        .repartitionByRange("_llm_position")
        .sortWithinPartitions("_llm_position")
        .drop("_llm_position")
    )
