"""Exact deduplication against a persistent digest index.

The index is a catalog table with one row per known text, bucketed and sorted by
the text's digest.  The texts of a batch are read once: their digests are
written, and everything else works on those rows.  A batch is first reduced to one row
per digest on the map side; those rows meet the index in a sort-merge anti-join
that shuffles the batch only, and what is new is appended.  Every row of the batch then learns
from one small row per digest what became of it; that join is split where a
digest is hot, so a text with a third of all rows is no obstacle.

``deduplicated`` adds a batch to a lasting index, in which earlier batches win.
``largest_stays`` works through one table in two batches, the larger ids first, so
that the row with the largest id stays and the second half meets the first in the index.
``kept_rows`` does the same where only the rows that stay are wanted: their texts are then
reduced to one row per digest on the map side and shuffled once, never written in between.

Adding a batch twice under the same name changes nothing, so a job that died
half-way is simply run again.

Defined results: NULL counts as the empty text.  Of equal texts in one batch the
row with the largest id stays (a NULL id is the smallest); among repeated rows
with that id, the one whose other columns hash highest, and of wholly equal rows
any one.  A text that an earlier batch brought is dropped, whatever its id.
Further columns are kept, clashing names give way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import whole_text, with_columns
from candlemill.operators.keyed import match_keyed, top_per_key
from candlemill.workspace import written

DIGEST = "text_sha256"
BUCKETS = 64


def digest_of(text: str) -> Column:
    return F.sha2(whole_text(text).cast("binary"), 256)


@dataclass(frozen=True)
class DigestIndex:
    """A digest table by catalog name, stored below ``path``.

    ``buckets`` holds for the life of the table; the catalog keeps it, and an
    append with another number is refused there.
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int = BUCKETS

    def rows(self) -> DataFrame | None:
        """Known texts, or None where nothing was added yet."""
        return self.spark.read.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest is not in the index; only they are shuffled, to its buckets."""
        known = self.rows()
        if known is None:
            return groups
        return groups.hint("merge").join(known.select(DIGEST), DIGEST, "left_anti")

    def add(self, groups: DataFrame) -> None:
        """Append the groups whose digest is not known, one file for each bucket."""
        bucket = F.pmod(F.hash(DIGEST), F.lit(self.buckets))  # how Spark numbers the buckets of a table
        (
            self.unknown(groups)
            .repartitionById(self.buckets, bucket)
            .write.format("parquet")
            .mode("append")
            .option("path", self.path)
            .bucketBy(self.buckets, DIGEST)
            .sortBy(DIGEST)
            .saveAsTable(self.name)
        )


def stamped(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """``df`` with its digests and a place for each row, stored: the texts are read and hashed once."""
    others = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns if keep_text or name != text])
    place = F.struct(
        F.col(f"`{doc_id}`").alias("id"), others.alias("hash"), F.monotonically_increasing_id().alias("number")
    )
    rows = with_columns(df, {DIGEST: digest_of(text), "_llm_place": place})
    return written(rows if keep_text else rows.drop(text), "stamped")


def judged(rows: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Stored rows of ``stamped``, added to the index, with ``keep_id``, ``group_size`` (in this batch) and ``kept``."""
    groups = rows.groupBy(DIGEST).agg(F.max("_llm_place").alias("keeper"), F.count("*").alias("group_size"))
    index.add(groups.select(DIGEST, "keeper", F.lit(batch).alias("batch")))
    fate = groups.select(DIGEST, "group_size").join(index.rows().hint("merge"), DIGEST)
    fate = fate.select(DIGEST, "group_size", F.col("keeper").alias("_llm_keeper"), F.col("batch").alias("_llm_batch"))
    joined = match_keyed(rows.drop("group_size"), fate, [DIGEST], "inner")
    kept = (F.col("_llm_batch") == batch) & F.col("_llm_keeper").eqNullSafe(F.col("_llm_place"))
    return with_columns(
        joined, {"keep_id": F.col("_llm_keeper.id"), "group_size": F.col("group_size"), "kept": kept}
    ).drop("_llm_keeper", "_llm_batch", "_llm_place")


def deduplicated(df: DataFrame, index: DigestIndex, batch: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with ``text_sha256``, ``keep_id``, ``group_size`` (in this batch) and ``kept``.

    ``batch`` names the rows that are added; rows of an earlier batch win.
    """
    return judged(stamped(df, text, doc_id), index, batch)


def _add_halves(groups: DataFrame, index: DigestIndex) -> None:
    """Groups of the larger ids go into the index first; the others meet them there."""
    for part, name in (("upper", "larger ids"), ("not upper", "other ids")):
        index.add(groups.where(part).select(DIGEST, "keeper", F.lit(name).alias("batch")))


def _upper_half(id_of: Column, middle: int | None) -> Column:
    return F.coalesce(id_of > F.lit(middle), F.lit(False)).alias("upper")


def kept_rows(df: DataFrame, index: DigestIndex, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay: of equal texts the one with the largest id, with ``text_sha256``.

    ``index`` is empty at first; ids are numbers.  Of rows that are equal in all columns any one stays.
    """
    others = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    place = F.struct(F.col(f"`{doc_id}`").alias("id"), others.alias("hash"), F.lit(0).cast("long").alias("number"))
    rows = with_columns(df, {DIGEST: digest_of(text), "_llm_place": place})
    id_of = F.col("_llm_place.id")
    middle = df.agg(F.percentile_approx(f"`{doc_id}`", 0.5)).first()[0]
    _add_halves(written(rows.groupBy(DIGEST, _upper_half(id_of, middle)).agg(F.max("_llm_place").alias("keeper")), "groups"), index)
    largest = top_per_key(rows, [DIGEST], [id_of.desc_nulls_last(), F.col("_llm_place.hash").desc()])
    known = index.rows().hint("merge").select(DIGEST, F.col("keeper").alias("_llm_keeper"))
    met = largest.join(known, DIGEST).where(F.col("_llm_keeper").eqNullSafe(F.col("_llm_place")))
    return met.drop("_llm_keeper", "_llm_place")


def largest_stays(
    df: DataFrame, index: DigestIndex, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True
) -> DataFrame:
    """``df`` (without its texts, if they are not kept) with ``text_sha256``, ``keep_id``, ``group_size`` and ``kept``.

    ``index`` is empty at first; ids are numbers.  The ids above the median go into it first, the rest
    (NULL among them) meets them there; sizes count both halves.
    """
    rows = stamped(df, text, doc_id, keep_text)
    id_of = F.col("_llm_place.id")
    middle = rows.agg(F.percentile_approx(id_of, 0.5)).first()[0]
    groups = rows.groupBy(DIGEST, _upper_half(id_of, middle)).agg(F.max("_llm_place").alias("keeper"), F.count("*").alias("_llm_size"))
    groups = written(groups, "groups")
    _add_halves(groups, index)
    sizes = groups.groupBy(DIGEST).agg(F.sum("_llm_size").alias("_llm_size"))
    fate = sizes.join(index.rows().hint("merge").select(DIGEST, F.col("keeper").alias("_llm_keeper")), DIGEST)
    joined = match_keyed(rows, fate, [DIGEST], "inner")
    # A place is one row's alone.
    added = {"keep_id": F.col("_llm_keeper.id"), "group_size": F.col("_llm_size"), "kept": F.col("_llm_keeper").eqNullSafe(F.col("_llm_place"))}
    return with_columns(joined, added).drop("_llm_keeper", "_llm_size", "_llm_place")
