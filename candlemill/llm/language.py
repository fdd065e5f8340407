"""Language identification by compression.

One zstandard dictionary per language holds raw sample text.  A text is encoded
against each of them; the language whose dictionary gives the fewest bytes wins,
and a narrow lead over the second one is a rejection.  Before encoding, a text
is lower-cased and every run of characters other than letters becomes one blank,
so capitals and junk cost the same everywhere.  Encoding goes block by block
over the whole text: each block starts from the dictionary alone, and its
memory is bounded however long the text is.

Defined results: a text that is NULL or has no letter is ``und`` with score 0;
so is every text where no language could be learned.  Equal sizes go to the
language that is first by code point, with score 0.  With one learned language
the score is 1.  Rows are judged one by one, so repeated rows and empty tables
need no rule; further columns are kept, clashing names give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import loads, modest_batches, with_columns
from candlemill.operators.keyed import top_per_key

#: The bounded sample a dictionary is made of: so many different texts of a
#: language, the first so many characters of each, and the bytes kept in all.
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 2048
SAMPLE_BYTES = 512
SAMPLE_PARTS = 16
DICTIONARY_BYTES = 128 << 10
#: Bytes encoded at a time, and blanks behind a block: with them a few words are
#: always encoded and never stored as they are, which would hide the difference.
BLOCK = 8192
LOAD_BYTES = 2_000_000
PADDING = b" " * 96
#: A lead below this share of the second size is a rejection.
MARGIN = 0.02
UNKNOWN = "und"


def plain(text: str) -> bytes:
    """Lower case, letters and marks only, one blank between."""
    return regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip().encode()


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A raw dictionary per language from a bounded sample of the labelled ``rows``.

    The sample is the texts with the smallest hashes, so it covers all files
    alike and copies count once.  The driver gets at most ``SAMPLE_TEXTS`` texts
    of ``SAMPLE_CHARS`` characters for each language.
    """
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("hash"), F.col(text).cast("string").alias("text")
    )
    hashes = labelled.select("lang", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(SAMPLE_PARTS)))
    # First the smallest of each part, so that no task sees the candidates of a whole language.
    few = top_per_key(hashes, ["lang", "part"], [F.col("hash")], SAMPLE_TEXTS).drop("part")
    chosen = top_per_key(few, ["lang"], [F.col("hash")], SAMPLE_TEXTS)
    sample = (
        labelled.join(F.broadcast(chosen), ["lang", "hash"])
        .groupBy("lang", "hash")
        .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
        .orderBy("lang", "hash")
        .collect()
    )
    dictionaries: dict[str, bytes] = {}
    for row in sample:
        so_far = dictionaries.get(row["lang"], b"")
        if words := plain(row["text"]):
            dictionaries[row["lang"]] = (so_far + b" " + words[:SAMPLE_BYTES])[:DICTIONARY_BYTES]
    return dictionaries


def _encoders(dictionaries: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    params = zstandard.ZstdCompressionParameters(
        window_log=18,
        hash_log=16,
        chain_log=16,
        search_log=5,
        min_match=4,
        target_length=32,
        strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    made = []
    for _, raw in sorted(dictionaries.items()):
        dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=params)
        made.append(zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary))
    return made


def _judged(text: str | None, names: list[str], encoders: list) -> tuple[str, float]:
    if not names or not text or not regex.search(r"\p{L}", text):
        return UNKNOWN, 0.0
    words = plain(text)
    blocks = [words[at : at + BLOCK] + PADDING for at in range(0, len(words), BLOCK)]
    sizes = [sum(len(encoder.compress(block)) for block in blocks) for encoder in encoders]
    best = min(range(len(names)), key=sizes.__getitem__)
    if len(names) == 1:
        return names[best], 1.0
    second = min(size for at, size in enumerate(sizes) if at != best)
    return names[best], 1.0 - sizes[best] / second


def identify(
    df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN
) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (the lead, 0 to 1) and ``rejected``.

    ``dictionaries`` is bounded by ``DICTIONARY_BYTES`` for each language and
    goes to the tasks with the function.
    """
    names = sorted(dictionaries)

    @F.arrow_udf("struct<lang: string, score: double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoders = _encoders(dictionaries)
        for batch in loads(batches, LOAD_BYTES):
            found = [_judged(value.as_py(), names, encoders) for value in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["lang", "score"],
            )

    # Otherwise a filter on the answer would be moved below and judge a second time.
    judged = with_columns(modest_batches(df), {"_llm_judged": judge.asNondeterministic()(F.col(text).cast("string"))})
    lang, score = F.col("_llm_judged.lang"), F.col("_llm_judged.score")
    rejected = (lang == UNKNOWN) | (score < margin)
    return with_columns(judged, {"lang_pred": lang, "score": score, "rejected": rejected}).drop("_llm_judged")


def held_out(id_column: str) -> Column:
    """The quarter of the rows that is never learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 4 == 2
