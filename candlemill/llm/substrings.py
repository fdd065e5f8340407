"""Removal of word sequences that repeat anywhere in a corpus, by fixed-block anchors.

A window is so many consecutive words of a text; every word is removed that
lies in a window whose words also start somewhere else.  Any window holds one
whole block of a grid of half its length, so it is enough to index the blocks of
that grid (the anchors, which do not overlap) and to probe them with the hash of
every rolling stretch of a block's length.  An anchor that is probed twice or
more (once by itself) is a hit.  Hits are extended: all windows over a hit anchor
are compared, again by hash, with the windows over other hits, and the union of
those that occur twice is the maximal repeats.

What travels.  Texts go through one shuffle, each different one once and packed;
its copies are counted on the map side.  Probes travel as sorted 32-bit rests
of hashes, an anchor with the key of its text and its number.  Within
a task's load of texts equal hashes are combined first: what occurs twice there
is a hit at once and sends its hash alone, so a passage that a third of all texts
share sends one hash per load, and each different text's hit anchors once per load,
however many copies of it the load has; they are spread over the buckets.  Buckets hold a fixed share of the hashes and
their number follows the input.  Rests of 32 bits may hit by chance; windows are
told apart by 96 bits and their bucket.

Defined results: a NULL text has no words; texts below a window's length lose
nothing; windows are judged on the input, not on what is left, and may overlap
their own repeats.  Repeated rows are repeats, so copies lose all words if they
are as long as a window.  An empty table gives no rows.  Further columns are
kept, clashing names give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import cuts, loads, modest_batches, whole_text, with_columns
from candlemill.operators.keyed import match_keyed

WINDOW = 35
#: Words whose hashes a task combines before it sends them, and bytes of text for each
#: bucket of hashes.  Both fit workers of some hundred megabytes; with larger ones,
#: raise both, as a load sends a row to each bucket and large rows pack better.
LOAD_WORDS = 1_500_000
BUCKET_BYTES = 16 << 20
#: Bytes of text that an Arrow function holds at a time.
LOAD_BYTES = 4_000_000
KEY = ["_llm_k1", "_llm_k2"]
_SEED = 20_25


def keyed(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a 128-bit key of the text."""
    return with_columns(df, {KEY[0]: F.xxhash64(F.lit(1), whole_text(text)), KEY[1]: F.xxhash64(F.lit(2), whole_text(text))})


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter((xxhash.xxh3_64_intdigest(word) for word in words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums, in place."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(33)
    return h


def rolling(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of all stretches of ``length`` words."""
    factors = np.random.default_rng([_SEED, seed]).integers(1, 1 << 63, length, np.uint64) * np.uint64(2) + np.uint64(1)
    size = max(0, len(words) - length + 1)
    total = np.zeros(size, np.uint64)
    for at in range(length):
        total += words[at : at + size] * factors[at]
    return _mixed(total)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def packed_rests(rests: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, byte by byte of all: the upper bytes are mostly zero."""
    steps = np.diff(rests, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked_rests(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)
    return np.cumsum(steps, dtype=np.uint64).astype(np.uint32)


def _cuts(sorted_buckets: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(sorted_buckets, np.arange(buckets + 1))


_SENT = pa.schema(
    [("bucket", pa.int32()), ("rests", pa.binary()), ("ones", pa.binary()), ("keys", pa.binary()), ("places", pa.binary()), ("known", pa.binary())]
)
_HIT = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("place", "<i4")])


def _hits_table(hits: np.ndarray) -> dict:
    return {KEY[0]: hits["k1"].copy(), KEY[1]: hits["k2"].copy(), "place": hits["place"].copy()}


def _loads(batches: Iterator[pa.RecordBatch], words_of, most: int) -> Iterator[list]:
    """Lists of (row, words) with about ``most`` words together; a row is (k1, k2, text, ..)."""
    load, held = [], 0
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            row = [value.as_py() for value in row]
            words = words_of(row)
            row[2] = None  # the text is not needed any more
            load.append((row, words))
            held += len(words)
            if held >= most:
                yield load
                load, held = [], 0
    if load:
        yield load


def _hits_once(k1: np.ndarray, k2: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Each different hit once: copies of a text have the same."""
    order = np.lexsort((places, k2, k1))
    hits = np.zeros(len(order), _HIT)
    hits["k1"], hits["k2"], hits["place"] = k1[order], k2[order], places[order]
    return hits[np.r_[True, hits[1:] != hits[:-1]][: len(hits)]]


def anchors_and_probes(buckets: int, block: int, load_words: int):
    """From (k1, k2, text) to rows per bucket: the probes, and the anchors that are not hits yet."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for load in _loads(batches, lambda row: word_hashes(row[2].encode()), load_words):
            lengths = np.array([len(words) for _, words in load])
            starts = np.cumsum(lengths) - lengths
            every = np.concatenate([words for _, words in load])
            hashes = rolling(every, block, 0)
            inside = np.zeros(len(every) + 1, np.int64)  # stretches that stay in their text
            counts = np.maximum(0, lengths - block + 1)
            has = counts > 0
            np.add.at(inside, starts[has], 1)
            np.add.at(inside, starts[has] + counts[has], -1)
            valid = np.cumsum(inside)[: len(hashes)] > 0
            numbers = np.maximum(0, lengths // block)  # whole blocks of the grid
            text_of = np.repeat(np.arange(len(load)), numbers)
            places = np.arange(len(text_of)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
            anchors = hashes[starts[text_of] + places * block] if len(text_of) else np.zeros(0, np.uint64)
            distinct, times = np.unique(hashes[valid], return_counts=True)
            known = times[np.searchsorted(distinct, anchors)] > 1
            k1 = np.array([row[0] for row, _ in load], np.int64)
            k2 = np.array([row[1] for row, _ in load], np.int64)
            hits = _hits_once(k1[text_of[known]], k2[text_of[known]], places[known])
            yield from _rows(distinct, times, anchors[~known], k1[text_of[~known]], k2[text_of[~known]], places[~known], hits, buckets)

    return send


def _rows(distinct, times, anchors, k1, k2, places, hits, buckets) -> Iterator[pa.RecordBatch]:
    """One row per bucket; sorted hashes are also sorted by bucket and, inside it, by their upper bits only."""
    columns: dict[str, list] = {field.name: [] for field in _SENT}
    repeated = np.repeat(distinct, np.minimum(times, 2))
    of = bucket_of(repeated, buckets)
    cuts = _cuts(of, buckets)
    order = np.argsort(anchors, kind="stable")
    anchors, k1, k2, places = anchors[order], k1[order], k2[order], places[order]
    anchor_cuts = _cuts(bucket_of(anchors, buckets), buckets)
    turn = (hits["k1"] % buckets + hits["place"]) % buckets  # a text's hits go to many buckets
    hits = hits[np.argsort(turn, kind="stable")]
    hit_cuts = _cuts(np.sort(turn), buckets)
    low = np.uint64(0xFFFFFFFF)
    # An anchor's own probe is among the rests, so these two say which buckets have anything.
    for bucket in np.flatnonzero(np.diff(cuts) + np.diff(hit_cuts)).tolist():
        a, b = cuts[bucket], cuts[bucket + 1]
        c, d = anchor_cuts[bucket], anchor_cuts[bucket + 1]
        e, f = hit_cuts[bucket], hit_cuts[bucket + 1]
        columns["bucket"].append(bucket)
        columns["rests"].append(packed_rests(np.sort((repeated[a:b] & low).astype(np.uint32))))
        columns["ones"].append((anchors[c:d] & low).astype("<u4").tobytes())
        columns["keys"].append(np.stack([k1[c:d], k2[c:d]], axis=1).astype("<i8").tobytes())
        columns["places"].append(places[c:d].astype("<u4").tobytes())
        columns["known"].append(hits[e:f].tobytes())
    yield pa.RecordBatch.from_pydict(columns, _SENT)


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


_HITS = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("place", pa.int32())])


def probed(table: pa.Table) -> pa.Table:
    """The hit anchors of a bucket."""
    rests = np.concatenate([np.zeros(0, np.uint32), *[unpacked_rests(data) for data in table["rests"].to_pylist()]])
    distinct, times = np.unique(rests, return_counts=True)
    twice = distinct[times > 1]
    ones = _joined(table["ones"], "<u4")
    keys = _joined(table["keys"], "<i8").reshape(-1, 2)
    hit = np.isin(ones, twice)
    found = np.zeros(int(hit.sum()), _HIT)
    found["k1"], found["k2"], found["place"] = keys[hit, 0], keys[hit, 1], _joined(table["places"], "<u4")[hit]
    return pa.table(_hits_table(np.concatenate([_joined(table["known"], _HIT), found])), _HITS)


_WINDOWS = pa.schema(
    [("bucket", pa.int32()), ("prints", pa.binary()), ("rests", pa.binary()), ("owners", pa.binary()), ("places", pa.binary()), ("keys", pa.binary()), ("known", pa.binary())]
)
#: Owner of a window that needs no answer, as it was already found twice.
NOBODY = np.uint32(0xFFFFFFFF)


def windows_over_hits(words: int, blocks: np.ndarray, block: int, window: int) -> np.ndarray:
    """Starts of the windows of a text that hold one of the hit blocks as the first whole block of the grid."""
    cover = np.zeros(words + 2, np.int64)
    first = np.maximum(0, blocks * block - block + 1)
    np.add.at(cover, first, 1)
    np.add.at(cover, blocks * block + 1, -1)
    return np.flatnonzero(np.cumsum(cover)[: max(0, words - window + 1)] > 0)


def windows_of_hits(buckets: int, block: int, window: int, load_words: int):
    """From (k1, k2, packed text, copies, hit blocks) to rows per bucket with the windows over hits."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for load in _loads(batches, lambda row: word_hashes(unpack.decompress(row[2])), load_words):
            h1, h2, text_of, places = [], [], [], []
            for number, (row, words) in enumerate(load):
                starts = windows_over_hits(len(words), np.unique(np.array(row[4], np.int64)), block, window)
                if len(starts):
                    h1.append(rolling(words, window, 1)[starts])
                    h2.append(rolling(words, window, 2)[starts])
                    text_of.append(np.full(len(starts), number, np.int64))
                    places.append(starts)
            if not h1:
                continue
            h1, h2, text_of, places = map(np.concatenate, (h1, h2, text_of, places))
            copies = np.array([row[3] for row, _ in load])
            k1 = np.array([row[0] for row, _ in load], np.int64)
            k2 = np.array([row[1] for row, _ in load], np.int64)
            order = np.lexsort((h2, h1))
            h1, h2, text_of, places = h1[order], h2[order], text_of[order], places[order]
            first = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            group = np.cumsum(first) - 1
            seen = np.bincount(group, weights=np.minimum(copies[text_of], 2))
            twice = seen[group] > 1
            # A window seen twice is known here; others only need to hear of it.
            known = twice & (copies[text_of] < 2)
            hits = np.zeros(int(known.sum()), _HIT)
            hits["k1"], hits["k2"], hits["place"] = k1[text_of[known]], k2[text_of[known]], places[known]
            turn = np.abs(hits["k1"] % buckets)
            hits = hits[np.argsort(turn, kind="stable")]
            hit_cuts = _cuts(np.sort(turn), buckets)
            h1, h2, text_of, places, twice = h1[first], h2[first], text_of[first], places[first], twice[first]
            cuts = _cuts(bucket_of(h1, buckets), buckets)
            columns: dict[str, list] = {field.name: [] for field in _WINDOWS}
            for bucket in np.flatnonzero(np.diff(cuts) + np.diff(hit_cuts)).tolist():
                a, b = cuts[bucket], cuts[bucket + 1]
                e, f = hit_cuts[bucket], hit_cuts[bucket + 1]
                by_text = a + np.lexsort((places[a:b], text_of[a:b], twice[a:b]))
                single = by_text[~twice[by_text]]
                texts, owner = np.unique(text_of[single], return_inverse=True)
                owners = np.r_[owner.astype(np.uint32), np.full(b - a - len(single), NOBODY)].astype("<u4")
                columns["bucket"].append(bucket)
                columns["prints"].append(h2[by_text].astype("<u8").tobytes())
                columns["rests"].append((h1[by_text] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                columns["owners"].append(owners.tobytes())
                columns["places"].append(places[single].astype("<u4").tobytes())
                columns["keys"].append(np.stack([k1[texts], k2[texts]], axis=1).astype("<i8").tobytes())
                columns["known"].append(hits[e:f].tobytes())
            yield pa.RecordBatch.from_pydict(columns, _WINDOWS)

    return send


_PACKED = pa.schema([("part", pa.int32()), ("hits", pa.binary())])


def repeats(table: pa.Table, parts: int) -> pa.Table:
    """The starts of repeated windows of a bucket, packed by the part of the texts they go to.

    A row per text would be nearly a row per window: a text has windows in most buckets.
    """
    prints, rests = _joined(table["prints"], "<u8"), _joined(table["rests"], "<u4")
    k1, k2, places, asks = [], [], [], []
    for owners, keys, at in zip(table["owners"].to_pylist(), table["keys"].to_pylist(), table["places"].to_pylist(), strict=True):
        owner = np.frombuffer(owners, "<u4")
        single = owner != NOBODY
        key = np.frombuffer(keys, "<i8").reshape(-1, 2)
        k1.append(key[owner[single], 0])
        k2.append(key[owner[single], 1])
        places.append(np.frombuffer(at, "<u4"))
        asks.append(single)
    asked = np.concatenate(asks)
    order = np.lexsort((rests, prints))
    first = np.r_[True, (prints[order][1:] != prints[order][:-1]) | (rests[order][1:] != rests[order][:-1])][: len(order)]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    seen = np.bincount(group, weights=np.where(asked, 1, 2)) if len(group) else np.zeros(0)
    hit = (seen[group] > 1)[asked]
    found = np.zeros(int(hit.sum()), _HIT)
    found["k1"], found["k2"], found["place"] = (np.concatenate(x)[hit] for x in (k1, k2, places))
    every = np.concatenate([_joined(table["known"], _HIT), found])
    part = np.abs(every["k1"] % parts)
    every = every[np.argsort(part, kind="stable")]
    cuts = _cuts(np.sort(part), parts)
    filled = np.flatnonzero(np.diff(cuts))
    return pa.table({"part": filled.astype(np.int32), "hits": [every[cuts[n] : cuts[n + 1]].tobytes() for n in filled]}, _PACKED)


_REPEATS = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("places", pa.list_(pa.int32()))])


def by_text(table: pa.Table) -> pa.Table:
    """One row per text of a part, with the starts of its repeated windows."""
    every = _joined(table["hits"], _HIT)
    every = every[np.lexsort((every["k2"], every["k1"]))]
    differs = (every["k1"][1:] != every["k1"][:-1]) | (every["k2"][1:] != every["k2"][:-1])
    edges = np.flatnonzero(np.r_[True, differs][: len(every)])
    offsets = pa.array(np.r_[edges, len(every)].astype(np.int32))
    places = pa.ListArray.from_arrays(offsets, pa.array(every["place"].copy()))
    return pa.table({KEY[0]: every["k1"][edges], KEY[1]: every["k2"][edges], "places": places}, _REPEATS)


def removed_words(words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    steps = np.zeros(words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps)[:words] > 0


def _kept(window: int):
    @F.arrow_udf("struct<n_words: long, n_removed: long, spans: array<struct<first: int, stop: int>>, kept: string>")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        unpack = zstandard.ZstdDecompressor()

        def kept_of(packed: bytes, copies: int, starts: list | None) -> dict:
            words = unpack.decompress(packed).split()
            if copies > 1 and len(words) >= window:
                gone = np.ones(len(words), bool)
            else:
                gone = removed_words(len(words), np.array(starts or [], np.int64), window)
            spans = np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2).tolist()
            left = [word for word, out in zip(words, gone.tolist(), strict=True) if not out] if spans else words
            return {
                "n_words": len(words),
                "n_removed": int(gone.sum()),
                "spans": [{"first": first, "stop": stop} for first, stop in spans],
                "kept": b" ".join(left).decode(),
            }

        kind = pa.struct(
            [("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.string())]
        )
        for batch in batches:
            for at, length in cuts(batch[0], LOAD_BYTES // 4):
                columns = (column.slice(at, length).to_pylist() for column in batch)
                yield pa.array([kept_of(*row) for row in zip(*columns, strict=True)], kind)

    return keep


def distinct_texts(df: DataFrame, window: int = WINDOW, text: str = "text", load_words: int = LOAD_WORDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per different text (by its key): ``n_words``, ``n_removed``, ``spans`` of removed words and the ``kept`` text."""
    block = (window + 1) // 2
    rows = keyed(modest_batches(df).select(F.col(f"`{text}`").alias("text")), "text").withColumn("text", whole_text("text"))
    size = df.agg(F.sum(F.octet_length(whole_text(text)))).first()[0] or 0
    buckets = int(max(8, size // bucket_bytes))

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in loads(batches, LOAD_BYTES):
            yield pa.array([pack.compress(value.as_py().encode()) for value in batch], pa.binary())

    texts = rows.select(*KEY, packed("text").alias("packed")).groupBy(*KEY).agg(F.first("packed").alias("packed"), F.count("*").alias("copies"))
    hits = (
        rows.select(*KEY, "text")
        .mapInArrow(anchors_and_probes(buckets, block, load_words), "bucket int, rests binary, ones binary, keys binary, places binary, known binary")
        .groupBy("bucket")
        .applyInArrow(probed, "_llm_k1 long, _llm_k2 long, place int")
        .groupBy(*KEY)
        .agg(F.collect_set("place").alias("blocks"))
    )
    repeated = (
        texts.join(hits, KEY)
        .select(*KEY, "packed", "copies", "blocks")
        .mapInArrow(windows_of_hits(buckets, block, window, load_words), "bucket int, prints binary, rests binary, owners binary, places binary, keys binary, known binary")
        .groupBy("bucket")
        .applyInArrow(lambda table: repeats(table, buckets), "part int, hits binary")
        .groupBy("part")
        .applyInArrow(by_text, "_llm_k1 long, _llm_k2 long, places array<int>")
    )
    judged = texts.join(repeated, KEY, "left").select(*KEY, _kept(window)("packed", "copies", "places").alias("_llm_kept"))
    return judged.select(*KEY, "_llm_kept.*")


def attached(df: DataFrame, results: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with what ``results`` has for each row's text."""
    added = [name for name in results.columns if name not in KEY]
    clashing = [name for name in df.columns if name.lower() in {x.lower() for x in added}]
    joined = match_keyed(keyed(df, text).drop(*clashing), results, KEY, "inner")
    return joined.drop(*KEY)


def without_repeats(df: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_removed``, ``spans`` and ``kept``, the words left joined by blanks."""
    return attached(df, distinct_texts(df, window, text), text)
