"""Token counts of whole texts under a sentencepiece model.

Texts go through an Arrow function that gives back lengths only.  Its batches
are balanced by bytes, not by rows, and a long text is encoded in pieces that
are cut where the model cannot merge across: at a blank that follows another
character.  Blanks become the model's word mark, and no vocabulary entry has a
word mark behind another character (checked when the model is loaded), so a cut
there changes nothing.  The piece behind the cut begins without its blank: the
mark the library puts in front of every text stands for it.

Defined results: a NULL or empty text has 0 tokens; rows are judged one by one,
so repeated rows, ties and an empty table need no rule; further input columns
are kept, clashing names give way to the operator's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import loads, modest_batches, whole_text, with_columns

MARK = "▁"
#: Characters of a piece, and bytes of a batch.
PIECE_CHARS = 50_000
BATCH_BYTES = 1_000_000


def cut(text: str, size: int) -> list[str]:
    """``text`` in pieces of about ``size`` characters whose token counts add up to its own."""
    pieces, start = [], 0
    while len(text) - start > size:
        at = start + size
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                pieces.append(text[start:])
                return pieces
            if text[at - 1] not in (" ", MARK):
                break
            at += 1
        pieces.append(text[start:at])
        start = at + 1
    pieces.append(text[start:])
    return pieces


def loaded(model: bytes) -> sentencepiece.SentencePieceProcessor:
    """The model; raises where cuts at blanks could change a count."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    entries = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any(MARK in entry.lstrip(MARK) for entry in entries) or len(processor.encode("a  a")) != 3:
        raise ValueError("this model merges across blanks or squeezes them, so long texts can't be cut")
    return processor


def _counted(processor, texts: list[str], piece_chars: int) -> list[int]:
    pieces = [(owner, piece) for owner, text in enumerate(texts) for piece in cut(text, piece_chars)]
    counts = [0] * len(texts)
    # A batch is a few short texts or one long one, which is then encoded piece by piece.
    groups = [pieces] if len(texts) > 1 else [[piece] for piece in pieces]
    for group in groups:
        for (owner, _), ids in zip(group, processor.encode([piece for _, piece in group], num_threads=1), strict=True):
            counts[owner] += len(ids)
    return counts


def count_tokens(
    df: DataFrame,
    model_path: str,
    text: str = "text",
    limit: int = 4096,
    piece_chars: int = PIECE_CHARS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    The model file (well below a megabyte) is read once and sent to the tasks.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = loaded(model)
        for batch in loads(batches, batch_bytes):
            yield pa.array(_counted(processor, batch.to_pylist(), piece_chars), pa.int64())

    # Otherwise a filter on the count would be moved below and count a second time.
    once = tokens.asNondeterministic()
    counted = with_columns(modest_batches(df), {"n_bytes": F.octet_length(whole_text(text)).cast("long"), "n_tokens": once(whole_text(text))})
    return with_columns(counted, {"over_limit": F.col("n_tokens") > limit})
