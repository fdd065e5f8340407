"""Fill-in-the-middle texts, cut at lines that chunk summaries locate.

A text is cut in two places between its lines, and its parts are told apart by
markers and put in another order.  The places are numbers of lines, so a task
has to know where in a text its k-th line ends.  A rolling hash over the bytes
cuts every text into chunks that depend on their content only: the hash looks
at 32 bytes, and a chunk has more, so a passage that texts share has the same
chunks in all of them.  A task keeps a summary of each different chunk (where
its lines end, how many characters it has), found by the whole chunk and
thereby verified by content.  Adding up the counts of a text's chunks says which
chunk holds a cut; the summary says where in it.  Bytes, line ends and
characters all add up over chunks, also where a chunk ends inside a character.

The summaries a task keeps are bounded: two halves of ``CACHE_BYTES``, of which
the older is given up when the younger is full; used chunks move to the younger.

Defined results: a NULL or empty text is plain and has no lines; a text that
holds a marker is plain; a NULL id counts as an empty one.  Rows are judged one by
one, so repeated rows get the same result, ties need no rule and an empty table
gives no rows.  Long texts are worked through chunk by chunk and in loads of
their own.  Further columns are kept, clashing names give way.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import cuts, modest_batches, whole_text, with_columns

#: Bytes of a chunk: on average, at least (above the hash's 32), at most.
AVERAGE, LEAST, MOST = 512, 64, 8192
CACHE_BYTES = 32 << 20
LOAD_BYTES = 4_000_000
MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint32)
_INSIDE_CHARACTER = bytes(range(0x80, 0xC0))


def rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes up to each byte: each doubling joins two neighbouring stretches."""
    hashes = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        hashes[step:] += hashes[:-step] << np.uint32(step)
    return hashes


def chunk_ends(candidates: list[int], start: int, stop: int) -> Iterator[int]:
    """Ends of the chunks of the bytes start .. stop, from the places where the hash allows one."""
    at = start
    for end in [*candidates, stop]:
        if end - at < LEAST and end < stop:
            continue
        while end - at > MOST:
            at += MOST
            yield at
        if end > at:
            yield end
            at = end


class Summary(NamedTuple):
    """Ends of the lines of a chunk, and its characters (counted where they begin)."""

    ends: list[int]
    chars: int


def characters(data: bytes) -> int:
    return len(data.translate(None, _INSIDE_CHARACTER))


class Summaries:
    """Summaries by chunk, the least recently used half given up when there are too many."""

    def __init__(self, most: int = CACHE_BYTES):
        self.half, self.held = most // 2, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}

    def of(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                ends = (np.flatnonzero(np.frombuffer(chunk, np.uint8) == 10) + 1).tolist() if b"\n" in chunk else []
                found = Summary(ends, characters(chunk))
            self.held += len(chunk)
            if self.held > self.half:
                self.young, self.old, self.held = {}, self.young, len(chunk)
            self.young[chunk] = found
        return found


class Lines:
    """Number of lines of a text, and where the first k of them end, from its chunks."""

    def __init__(self, text: bytes, chunks: list[bytes], summaries: Summaries):
        self.text, self.chunks = text, chunks
        self.found = [summaries.of(chunk) for chunk in chunks]
        self.ends = list(accumulate(len(one.ends) for one in self.found))
        closed = self.ends[-1] if chunks else 0
        self.count = closed + (1 if text and not text.endswith(b"\n") else 0)

    def head(self, lines: int) -> tuple[int, int]:
        """Bytes and characters of the first ``lines`` lines."""
        if lines == 0:
            return 0, 0
        if lines == self.count:
            return len(self.text), sum(one.chars for one in self.found)
        at = bisect_left(self.ends, lines)
        inside = self.found[at].ends[lines - 1 - (self.ends[at - 1] if at else 0)]
        before = sum(map(len, self.chunks[:at]))
        return before + inside, sum(one.chars for one in self.found[:at]) + characters(self.chunks[at][:inside])


def chunked(texts: pa.Array) -> Iterator[tuple[bytes, list[bytes]]]:
    """Each text with its chunks; one pass of the hash over all bytes of the load."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist()
    held = texts.buffers()[2]
    data = np.frombuffer(held if held is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
    places = (np.flatnonzero(rolling(data) < np.uint32((1 << 32) // AVERAGE)) + 1).tolist()
    whole, first = data.tobytes(), 0
    for start, stop in zip(offsets, offsets[1:], strict=False):
        start, stop = start - offsets[0], stop - offsets[0]
        last = bisect_left(places, stop, first)
        chunks, at = [], start
        for end in chunk_ends(places[first:last], start, stop):
            chunks.append(whole[at:end])
            at = end
        first = last
        yield whole[start:stop], chunks


def rearranged(text: bytes, lines: Lines, draw: bytes, rate: int, spm: int, markers: list[bytes]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text; ``draw`` decides the cuts and the form."""
    n = lines.count
    if not text or any(marker in text for marker in markers):
        return n, PLAIN, None, None, text
    digits = hashlib.sha256(draw).hexdigest()
    one, two, chance, order = (int(digits[at : at + 8], 16) for at in (0, 8, 16, 24))
    if chance % 100 >= rate:
        return n, PLAIN, None, None, text
    first, last = sorted((one % (n + 1), two % (n + 1)))
    (a, prefix_chars), (b, chars) = lines.head(first), lines.head(last)
    p, s, m = markers
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < spm:
        return n, SPM, prefix_chars, chars - prefix_chars, b"".join((s, suffix, p, prefix, m, middle))
    return n, PSM, prefix_chars, chars - prefix_chars, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    df: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, markers: tuple[str, str, str] = MARKERS,
    text: str = "text", doc_id: str = "doc_id", cache_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """``df`` with ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` per cent of the texts are rearranged, ``spm`` per cent of those with the
    suffix first.  The sha256 of ``seed:id`` decides which, and where a text is cut.
    """
    kinds = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
    marks = [marker.encode() for marker in markers]

    @F.arrow_udf("struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>")
    def infilled(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        summaries = Summaries(cache_bytes)
        for texts, draws in batches:
            for start, length in cuts(texts, LOAD_BYTES):
                load, told = texts.slice(start, length), draws.slice(start, length).to_pylist()
                done = [
                    rearranged(one, Lines(one, chunks, summaries), draw.encode(), rate, spm, marks)
                    for (one, chunks), draw in zip(chunked(load), told, strict=True)
                ]
                columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*done, strict=True), kinds, strict=True)]
                yield pa.StructArray.from_arrays(columns, [name for name, _ in kinds])

    draw = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    done = with_columns(modest_batches(df), {"_llm_infilled": infilled.asNondeterministic()(whole_text(text), draw)})
    return with_columns(done, {name: F.col(f"_llm_infilled.{name}") for name, _ in kinds}).drop("_llm_infilled")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made of; each marker is in it once."""
    p, s, m = markers

    def between(begin: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, begin, -1), end, 1)

    middle = F.substring_index(output, m, -1)
    return (
        F.when(form == PSM, F.concat(between(p, s), middle, between(s, m)))
        .when(form == SPM, F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
