"""From raw documents to token ids: language, exact copies, near copies, mix, tokens.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and works on all
rows that the one before kept.  ``run`` writes what a stage returns to the
folder that the cluster shares and reads it back for the next one; what a stage
leaves behind besides, and its input, are then removed.

Defined results: texts without letters, NULL and empty ones among them, have no
language and go at the first stage; given to the others alone, they count as empty
texts (equal to each other, without words for the mix, without tokens).  A NULL
``lang`` is filled in, a NULL ``source`` is a source of its own, a NULL ``doc_id`` is smaller
than any other.  Repeated rows are copies, of which one stays.  Of ties between equal
texts the largest id stays, between near copies the smallest.  Very long texts are worked
through whole.  An empty table goes through all stages.  Columns beyond those of
``documents`` are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from candlemill.llm import bpe, exact, language, mixing, simhash
from candlemill.llm.queries import RANKS, learned_languages, new_index
from candlemill.registry.base import table
from candlemill.workspace import new_folder, remove, scratch, written_to

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL can compress by language, hash shingles or merge byte pairs.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised by a clear lead; a missing ``lang`` is filled in."""
    found = language.identify(docs, learned_languages(docs)).where(~F.col("rejected"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact.kept_rows(docs.select(*COLUMNS), new_index(spark)).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs, shingle=3, radius=2).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix in order of position: a row for each reading of a document, the last one perhaps in part."""
    mix = mixing.curriculum(mixing.assigned(docs.select(*COLUMNS)), COLUMNS)
    return mix.withColumn("n_chars", F.char_length("text").cast("long"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, how many bytes they decode to, and the digest of those."""
    done = bpe.encoded_and_decoded(docs, RANKS, public_tokenizers.PATTERN)
    return done.select("doc_id", "lang", "source", "n_tokens", "token_ids", "n_bytes", "decoded_sha256")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = new_folder(spark, "stage")
        with scratch(spark):
            docs = written_to(stage(spark, docs, sf_dir), path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
