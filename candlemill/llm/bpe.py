"""Byte-level BPE by replaying the merges over a corpus of words.

The texts of a task are a corpus, worked through in loads.  The split pattern cuts
them into words, of which each different one is held and merged once; the new words of a
load are a row of linked symbols in flat arrays.  An
inverted index from the rank of a pair's merge to the positions of that pair is
then replayed in rank order: all positions of a rank are merged at once, only
the pairs to the left and right of a merge are looked up anew, and what they can
become is filed under its rank.  Positions that were merged away or changed since they were
filed are skipped.  Texts are the symbols of their words in sequence.

This is the greedy rule of the library (the lowest rank first, the leftmost of
equals), taken for all words of a load together: words are independent, and a
merge of rank r only ever has to wait for lower ranks of its own word.  As in
the library, a word that is a vocabulary entry is that entry.

Corpora are tasks and not the whole table on purpose: looking the words of
all texts up in a table of all words would shuffle every word of every text.
What a task keeps of its words is bounded by ``KNOWN_BYTES``; beyond it, it begins anew.
Long texts are cut in front of white space that follows other characters, where
the pattern never matches across, so a batch's memory is bounded.

Defined results: a NULL or empty text has no ids and decodes to nothing.  Rows
are judged one by one.  Further columns are kept, clashing names give way.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import loads, modest_batches, whole_text, with_columns

#: Bytes of a corpus, and characters of the parts that long texts are cut into.
CORPUS_BYTES = 2_000_000
PART_CHARS = 1_000_000
#: Bytes of different words that a task keeps with their ids.
KNOWN_BYTES = 16 << 20
#: Behind it the split pattern starts a new match, whatever follows.
_EDGE = regex.compile(r"(?<=\S)(?=\s)")


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank, from a file of base64 entries and ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    entries = {int(rank): base64.b64decode(entry) for entry, rank in pairs}
    return [entries[rank] for rank in range(len(entries))]


class _Numbers(dict):
    """Words by number, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def _once(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted positions of some sorted arrays, each once."""
    if len(parts) == 1:
        return parts[0]
    every = np.sort(np.concatenate(parts))
    return every[np.r_[True, every[1:] != every[:-1]]] if len(every) else every


class Replay:
    """The merges of a vocabulary, applied to corpora of words."""

    def __init__(self, entries: list[bytes], known_bytes: int = KNOWN_BYTES):
        self.known_bytes = known_bytes
        self._forget()
        self.entries = entries
        self.rank = {entry: rank for rank, entry in enumerate(entries)}
        self.byte_rank = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for merged, entry in enumerate(entries):
            for at in range(1, len(entry)):
                left, right = self.rank.get(entry[:at]), self.rank.get(entry[at:])
                if left is not None and right is not None:
                    pairs[left * len(entries) + right] = merged
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[key] for key in self.keys.tolist()], np.int64)

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what two symbols merge to, -1 where they don't."""
        keys = left * len(self.entries) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in sequence, and where each word's ids begin (one more at the end)."""
        whole = np.array([self.rank.get(word, -1) for word in words], np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        lengths[whole >= 0] = 1
        ends = np.cumsum(lengths)
        starts = ends - lengths
        size = int(ends[-1]) if len(words) else 0
        symbol = np.empty(size, np.int64)
        symbol[starts[whole >= 0]] = whole[whole >= 0]
        spelled = b"".join(word for word, known in zip(words, whole.tolist(), strict=True) if known < 0)
        alone = np.zeros(size, bool)
        alone[starts[whole >= 0]] = True
        symbol[~alone] = self.byte_rank[np.frombuffer(spelled, np.uint8)]
        # Links inside a word; -1 beyond its ends.
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1], before[starts] = -1, -1
        alive = np.ones(size, bool)
        merge = np.full(size, -1, np.int64)
        inner = np.flatnonzero(after >= 0)
        merge[inner] = self._merge_of(symbol[inner], symbol[inner + 1])

        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def file(positions: np.ndarray) -> None:
            positions = positions[merge[positions] >= 0]
            if len(positions):
                ranks = merge[positions]
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
                edges = np.flatnonzero(np.diff(ranks)) + 1
                for part, rank in zip(np.split(positions, edges), ranks[np.r_[0, edges]].tolist(), strict=True):
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(waiting, rank)
                    index[rank].append(part)

        file(inner)
        while waiting:
            rank = heapq.heappop(waiting)
            at = _once(index.pop(rank))
            at = at[merge[at] == rank]
            if not len(at):
                continue
            if (symbol[at] == symbol[after[at]]).any():  # "aaa": every second one of a run
                linked = np.r_[False, after[at[:-1]] == at[1:]]
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(linked, 0, place))) % 2 == 0]
            gone = after[at]
            symbol[at] = rank
            alive[gone] = False
            merge[gone] = -1
            then = after[gone]
            after[at] = then
            before[then[then >= 0]] = at[then >= 0]
            merge[at] = -1
            left = before[at]
            left = left[left >= 0]
            touched = _once([left, at[then >= 0]])
            touched = touched[alive[touched]]
            merge[touched] = self._merge_of(symbol[touched], symbol[after[touched]])
            file(touched)
        counts = np.add.reduceat(alive, starts, dtype=np.int64) if size else np.zeros(0, np.int64)
        return symbol[alive], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def _forget(self) -> None:
        """Begin a new corpus."""
        self.number, self.held = _Numbers(), 0
        self.ids, self.begins = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """Merge new words and keep their ids behind those of the words before."""
        ids, begins = self.encode_words(words)
        self.ids = np.concatenate([self.ids, ids])
        self.begins = np.concatenate([self.begins, self.begins[-1] + begins[1:]])
        self.held += sum(map(len, words))

    def encode(self, texts: list[str], pattern) -> list[np.ndarray]:
        """Ids of each text; words that earlier texts had are not merged again."""
        if self.held > self.known_bytes:
            self._forget()
        before = len(self.number)
        sequences = []
        for text in texts:
            sequences.append(
                np.concatenate(
                    [np.zeros(0, np.int64)]
                    + [
                        np.fromiter(map(self.number.__getitem__, pattern.findall(part)), np.int64)
                        for part in parts_of(text, PART_CHARS)
                    ]
                )
            )
        self._learn([word.encode() for word in islice(self.number, before, None)])
        ids, begins = self.ids, self.begins
        lengths = np.diff(begins)
        encoded = []
        for sequence in sequences:
            sizes = lengths[sequence]
            total = int(sizes.sum())
            inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            encoded.append(ids[np.repeat(begins[sequence], sizes) + inside].astype(np.int32))
        return encoded

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


def parts_of(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that the pattern would not match across."""
    start = 0
    while len(text) - start > size:
        edge = _EDGE.search(text, start + size)
        if edge is None:
            break
        yield text[start : edge.start()]
        start = edge.start()
    if start < len(text):
        yield text[start:]


def encoded(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", corpus_bytes: int = CORPUS_BYTES
) -> DataFrame:
    """``df`` with ``token_ids`` and ``n_tokens``.

    The vocabulary (below a megabyte or two) is read once and sent to the tasks.
    """
    entries = read_ranks(ranks_path)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay, matches = Replay(entries), regex.compile(pattern)
        for corpus in loads(batches, corpus_bytes):
            found = replay.encode(corpus.to_pylist(), matches)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))

    done = with_columns(modest_batches(df), {"token_ids": ids.asNondeterministic()(whole_text(text))})
    return with_columns(done, {"n_tokens": F.size("token_ids").cast("long")})


def decoded(df: DataFrame, ranks_path: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes that the ids stand for; NULL ids give no bytes."""
    entries = read_ranks(ranks_path)

    @F.arrow_udf("binary")
    def spelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([b"".join(entries[i] for i in row or ()) for row in batch.to_pylist()], pa.binary())

    return with_columns(modest_batches(df), {"decoded": spelled(F.col(ids))})


def encoded_and_decoded(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", corpus_bytes: int = CORPUS_BYTES
) -> DataFrame:
    """``df`` with ``token_ids``, ``n_tokens``, and the number ``n_bytes`` and digest ``decoded_sha256`` of the bytes the ids decode to."""
    entries = read_ranks(ranks_path)
    kinds = {"ids": pa.list_(pa.int32()), "size": pa.int64(), "bytes": pa.string()}

    @F.arrow_udf("struct<ids: array<int>, size: long, bytes: string>")
    def both_ways(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay, matches = Replay(entries), regex.compile(pattern)
        for corpus in loads(batches, corpus_bytes):
            found = replay.encode(corpus.to_pylist(), matches)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            sizes, digests = [], []
            for ids in found:
                spelled = replay.decode(ids)
                sizes.append(len(spelled))
                digests.append(hashlib.sha256(spelled).hexdigest())
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            columns = [ids, pa.array(sizes, kinds["size"]), pa.array(digests, kinds["bytes"])]
            yield pa.StructArray.from_arrays(columns, fields=[pa.field(name, kind) for name, kind in kinds.items()])

    done = with_columns(modest_batches(df), {"_llm_coded": both_ways.asNondeterministic()(whole_text(text))})
    added = {"token_ids": "ids", "n_bytes": "size", "decoded_sha256": "bytes"}
    done = with_columns(done, {name: F.col(f"_llm_coded.{field}") for name, field in added.items()}).drop("_llm_coded")
    return with_columns(done, {"n_tokens": F.size("token_ids").cast("long")})


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", corpus_bytes: int = CORPUS_BYTES
) -> DataFrame:
    """``df`` with ``n_tokens`` and digests of the ids (little-endian, 32 bits) and of the bytes they decode to."""
    entries = read_ranks(ranks_path)

    @F.arrow_udf("struct<n: long, ids: string, bytes: string>")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        replay, matches = Replay(entries), regex.compile(pattern)
        for corpus in loads(batches, corpus_bytes):
            rows = []
            for found in replay.encode(corpus.to_pylist(), matches):
                written = hashlib.sha256(found.astype("<u4").tobytes()).hexdigest()
                rows.append((len(found), written, hashlib.sha256(replay.decode(found)).hexdigest()))
            columns = [pa.array([row[at] for row in rows], kind) for at, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.StructArray.from_arrays(columns, ["n", "ids", "bytes"])

    done = with_columns(modest_batches(df), {"_llm_digests": digests.asNondeterministic()(whole_text(text))})
    fields = {"n_tokens": "n", "ids_sha256": "ids", "decoded_sha256": "bytes"}
    return with_columns(done, {name: F.col(f"_llm_digests.{field}") for name, field in fields.items()}).drop("_llm_digests")
