"""Removal of lines that many documents share, by sorted ranges of line hashes.

Long lines become rows of (hash of the line's key, document, position); texts
are not sent along.  The hashes are range-partitioned and each range is
sorted by hash, then document from the largest down, then position, so that
one pass over a range meets the first occurrence of a key in each document
one behind the other: a window that looks one row back tells them, and counting them
needs no memory.  The range key goes on behind the hash with a slice of the documents,
so the ranges of a line that a third of all rows hold lie in many tasks; the
few numbers of the slices (first document, documents) are added up per key.

Keys in too few documents end there.  The others meet the line rows again,
in a join that adaptive execution splits where a key is hot, and what comes back per
document is its keep bitmap, compressed to the stretches of lines that go.

The line rows are written once, in the shared folder: a lost executor costs no second pass over
the texts, nor does the sampling of the ranges.

Defined results: a NULL or empty text is one empty line, which is too short to go.
Rows with the same id are one document: they count once and keep or lose lines
alike.  A NULL id is a document too, and the smallest.  Lines that repeat within
a document stay or go together.  An empty table gives no rows.  Further
columns are kept, clashing names give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import whole_text, with_columns
from candlemill.operators.keyed import match_keyed
from candlemill.workspace import written

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
#: Parts of the documents that a key's rows are dealt to.
SLICES = 64
HASH = ["_llm_h1", "_llm_h2"]
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: str) -> Column:
    return F.split(whole_text(text), "\n", -1)


def key_of(line: Column) -> Column:
    """The line without blanks at its ends, A to Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def occurrences(df: DataFrame, text: str, doc_id: str, least_chars: int) -> DataFrame:
    """A row for each long line: hash, document, digest of its text, position."""
    lines = df.select(
        F.col(f"`{doc_id}`").alias("_llm_doc"), F.xxhash64(whole_text(text)).alias("_llm_text"),
        F.posexplode(lines_of(text)).alias("_llm_at", "_llm_line"),
    ).where(F.char_length("_llm_line") >= least_chars)
    keyed = lines.withColumn("_llm_key", key_of(F.col("_llm_line"))).where(F.char_length("_llm_key") >= least_chars)
    hashes = [F.xxhash64(F.lit(seed), "_llm_key").alias(name) for seed, name in enumerate(HASH)]
    part = F.pmod(F.xxhash64("_llm_doc"), F.lit(SLICES)).cast("int").alias("_llm_slice")
    return keyed.select(*hashes, part, "_llm_doc", "_llm_text", "_llm_at")


def first_occurrences(rows: DataFrame) -> DataFrame:
    """Of each key and document one row, streamed from ranges sorted by hash, document and position."""
    span = [*HASH, "_llm_slice"]
    down = Window.partitionBy(*span).orderBy(F.col("_llm_doc").desc_nulls_last(), "_llm_at")
    begins = F.lag(F.lit(True)).over(down).isNull()
    other = ~F.lag("_llm_doc").over(down).eqNullSafe(F.col("_llm_doc"))
    ranged = rows.select(*span, "_llm_doc", "_llm_at").repartitionByRange(*span)
    return ranged.withColumn("_llm_first", begins | other).where("_llm_first")


def shared_keys(rows: DataFrame, least_documents: int) -> DataFrame:
    """Keys in enough documents, with the largest of these."""
    slices = first_occurrences(rows).groupBy(*HASH, "_llm_slice").agg(F.max("_llm_doc").alias("_llm_top"), F.count("*").alias("_llm_docs"))
    keys = slices.groupBy(*HASH).agg(F.max("_llm_top").alias("_llm_keeper"), F.sum("_llm_docs").alias("_llm_docs"))
    return keys.where(F.col("_llm_docs") >= least_documents).drop("_llm_docs")


def _stretches(positions: Column) -> Column:
    """Sorted numbers as stretches of neighbours, from ``first`` to before ``stop``."""
    firsts = F.filter(positions, lambda x, i: (i == 0) | (F.get(positions, i - 1) < x - 1))
    lasts = F.filter(positions, lambda x, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) > x + 1))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("stop")))


def keep_bitmaps(
    df: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``_llm_doc``, ``_llm_text`` and ``dropped`` of each document that loses lines.

    ``dropped`` is the document's keep bitmap, compressed: the stretches of zeros.
    """
    rows = written(occurrences(df, text, doc_id, least_chars), "lines")
    elsewhere = ~F.col("_llm_doc").eqNullSafe(F.col("_llm_keeper"))
    gone = match_keyed(rows, shared_keys(rows, least_documents), HASH, "inner", elsewhere)
    places = gone.groupBy("_llm_doc", "_llm_text").agg(F.sort_array(F.collect_set("_llm_at")).alias("_llm_places"))
    return places.select("_llm_doc", "_llm_text", _stretches(F.col("_llm_places")).alias("dropped"))


def without_shared_lines(
    df: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``df`` with ``n_lines`` (before dropping), ``n_dropped`` and ``dropped``, the stretches of lines that go."""
    maps = keep_bitmaps(df, least_chars, least_documents, text, doc_id)
    maps = maps.select(F.col("_llm_doc").alias("_llm_doc2"), F.col("_llm_text").alias("_llm_text2"), F.col("dropped").alias("_llm_dropped"))
    here = df.withColumn("_llm_text", F.xxhash64(whole_text(text)))
    # <=> lets a hot side be split, as in match_keyed, and matches the NULL id.
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_llm_doc2")) & F.col("_llm_text").eqNullSafe(F.col("_llm_text2"))
    joined = here.join(maps, same, "left")
    dropped = F.coalesce("_llm_dropped", F.array().cast("array<struct<first: int, stop: int>>"))
    added = {
        "n_lines": F.size(lines_of(text)).cast("long"),
        "n_dropped": F.aggregate(dropped, F.lit(0), lambda n, s: n + s["stop"] - s["first"]).cast("long"),
        "dropped": dropped,
    }
    return with_columns(joined, added).drop("_llm_text", "_llm_doc2", "_llm_text2", "_llm_dropped")


def kept_text(text: str = "text", dropped: str = "dropped") -> Column:
    """The lines of a text that stay, joined again."""
    gone = F.col(dropped)

    def joined(lines: Column) -> Column:
        def stay(i: Column) -> Column:
            begin = F.coalesce(F.get(gone, i - 1)["stop"], F.lit(0))
            return F.slice(lines, begin + 1, F.coalesce(F.get(gone, i)["first"], F.size(lines)) - begin)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stay)), "\n")

    # The text is split once, not for each stretch.
    kept = F.element_at(F.transform(F.array(lines_of(text)), joined), 1)
    return F.when(F.size(gone) == 0, whole_text(text)).otherwise(kept)
