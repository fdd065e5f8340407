"""Near-duplicates by SimHash, compared in bit slices.

A fingerprint bit is set where more than half of a text's shingle hashes have it
set.  Fingerprints link where at most ``radius`` bits differ.

Candidates share all bits of a mask.  The masks leave out every choice of
``radius`` out of ``radius + 2`` equal stretches of the 64 bits, so that any two
fingerprints within the radius agree on one of them.  Fingerprints (each once,
however many documents have it) are grouped by mask and masked value.  A group
larger than ``LARGEST`` is not compared as it is: its masks are extended by each
of ``radius + 1`` stretches of the bits left free, one of which must again agree,
and its members are grouped anew.  So no pair is lost, no task gets an unbounded
group, and where few bits are free a group is small by arithmetic.

Groups are compared in bit slices: 64 members make a word, whose bit planes are
stored vertically, one per fingerprint bit.  A member meets a word by one XOR a
plane; the differences of 64 pairs are added up together in carry-save counters,
and a meeting is abandoned as soon as all its pairs exceed the radius.  A group
gives back links that connect what is linked, not all its pairs.

Defined results: words are what is between ASCII white space, in lower case for
A-Z; with fewer words than a shingle has, all of them are the one shingle;
NULL and empty texts have the fingerprint zero, which is linked like any other.
Equal fingerprints are linked.  NULL ids count as larger than any id; a
component of NULL ids only has a NULL id.  An empty table gives no rows.
Further columns are kept, clashing names give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import loads, modest_batches, whole_text, with_columns
from candlemill.llm.components import components
from candlemill.operators.keyed import match_keyed
from candlemill.workspace import checkpointed

BITS = 64
SEED = 42
#: Distinct fingerprints that are compared in one group.
LARGEST = 4096
#: Shingle hashes whose bits are counted at a time, bytes of text, and meetings compared
#: at a time (each of 64 pairs, all of which may be links).
COUNTED = 50_000
LOAD_BYTES = 4_000_000
MEETINGS = 10_000


def fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    first, last = (starts[: len(words) - shingle + 1], ends[shingle - 1 :]) if len(words) >= shingle else (starts[:1], ends[-1:])
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(first), COUNTED):
        spans = zip(first[at : at + COUNTED].tolist(), last[at : at + COUNTED].tolist(), strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8", len(first[at : at + COUNTED]))
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``df`` with ``_llm_print``, the fingerprint as a signed 64-bit number."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in loads(batches, LOAD_BYTES):
            found = np.array([fingerprint(value.as_py(), shingle) for value in batch], np.uint64)
            yield pa.array(found.view(np.int64))

    return with_columns(modest_batches(df), {"_llm_print": prints(whole_text(text))})


def stretches(free: list[int], parts: int) -> list[list[int]]:
    return [part.tolist() for part in np.array_split(np.array(free), parts)]


def signed_mask(bits: list[int]) -> int:
    mask = sum(1 << bit for bit in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def first_masks(radius: int) -> dict[int, list[int]]:
    """Masks (signed) that any two fingerprints within the radius agree on one of, and their free bits."""
    parts = stretches(list(range(BITS)), radius + 2)
    masks = {}
    for left_out in combinations(range(len(parts)), radius):
        free = [bit for at in left_out for bit in parts[at]]
        masks[signed_mask([bit for bit in range(BITS) if bit not in free])] = free
    return masks


def next_masks(masks: dict[int, list[int]], radius: int) -> tuple[dict[int, list[int]], dict[int, list[int]]]:
    """Extensions of each mask by a stretch of its free bits; the new masks and their free bits."""
    children, free_bits = {}, {}
    for mask, free in masks.items():
        for part in stretches(free, radius + 1):
            rest = [bit for bit in free if bit not in part]
            child = signed_mask([bit for bit in range(BITS) if bit not in rest])
            children.setdefault(mask, []).append(child)
            free_bits[child] = rest
    return children, free_bits


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of words of 64 members: [plane, word]."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T.reshape(BITS, -1, BITS), axis=2, bitorder="little")
    return packed.reshape(BITS, -1, 8).copy().view("<u8").reshape(BITS, -1)


def near(planes: np.ndarray, filled: np.ndarray, values: np.ndarray, member: np.ndarray, word: np.ndarray, radius: int):
    """Which members of a word are within the radius of a member: (meeting, bits) of those meetings that have any.

    ``member`` and ``word`` name the two sides of each meeting.
    """
    alive = np.arange(len(member))
    # Carry-save counters of radius + 1: one plane per binary digit, and those that have exceeded the radius.
    digits = [np.zeros(len(member), np.uint64) for _ in range((radius + 1).bit_length())]
    exceeded = ~filled[word]
    for plane in range(BITS):
        own = np.zeros(len(alive), np.uint64) - ((values[member[alive]] >> np.uint64(plane)) & np.uint64(1))
        carry = (planes[plane, word[alive]] ^ own) & ~exceeded
        for at, digit in enumerate(digits):
            digits[at], carry = digit ^ carry, digit & carry
        over = np.full(len(alive), ~np.uint64(0), np.uint64)
        for at, digit in enumerate(digits):
            over &= digit if (radius + 1) >> at & 1 else ~digit
        exceeded = exceeded | over
        if plane % 8 == 7:
            going = exceeded != ~np.uint64(0)
            if not going.all():
                alive, exceeded = alive[going], exceeded[going]
                digits = [digit[going] for digit in digits]
                if not len(alive):
                    break
    return alive, ~exceeded


def connected(size: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (smallest member reached so far) after linking a with b."""
    while len(a):
        left, right = label[a], label[b]
        apart = left != right
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
    return label


def linked(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members of a group that are linked, for many groups at once."""
    sizes = np.array([len(group) for group in groups])
    words = -(-sizes // BITS)
    # Members in words of their group; the last word of a group is filled up with zeros.
    begins = np.concatenate([[0], np.cumsum(words)]) * BITS
    values = np.zeros(int(begins[-1]), np.uint64)
    there = np.zeros(len(values), bool)
    for group, begin in zip(groups, begins[:-1].tolist(), strict=True):
        values[begin : begin + len(group)] = group
        there[begin : begin + len(group)] = True
    planes = _planes(values)
    filled = np.packbits(there.reshape(-1, BITS), axis=1, bitorder="little").copy().view("<u8").reshape(-1)
    label = np.arange(len(values))
    members = np.flatnonzero(there)
    group_of = np.repeat(np.arange(len(groups)), sizes)
    # Each member meets the words of its group from its own on: a pair meets once.
    own_word = members // BITS
    meetings = begins[group_of + 1] // BITS - own_word
    edges = np.concatenate([[0], np.cumsum(meetings)])
    start = 0
    while start < len(members):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + MEETINGS, side="right")) - 1)
        counts = meetings[start:stop]
        member = np.repeat(members[start:stop], counts)
        word = np.repeat(own_word[start:stop], counts) + np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
        which, bits = near(planes, filled, values, member, word, radius)
        unpacked = np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        meeting, bit = np.nonzero(unpacked)
        a, b = member[which[meeting]], word[which[meeting]] * BITS + bit
        label = connected(len(label), a[a < b], b[a < b], label)
        start = stop
    moved = members[label[members] != members]
    return values[moved], values[label[moved]]


def links(prints: DataFrame, radius: int, largest: int = LARGEST) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``prints`` within the radius."""

    @F.arrow_udf("array<struct<a: long, b: long>>")
    def compare(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            groups = [np.array(group, np.int64).view(np.uint64) for group in batch.to_pylist()]
            a, b = linked(groups, radius) if groups else ((), ())
            found = [{"a": x, "b": y} for x, y in zip(np.array(a, np.uint64).view(np.int64).tolist(), np.array(b, np.uint64).view(np.int64).tolist(), strict=True)]
            # All links of the batch stand in its first row.
            yield pa.array([found, *[[]] * (len(groups) - 1)] if groups else [], kind)

    masks = first_masks(radius)
    members = prints.select(F.explode(F.array(*[F.lit(mask) for mask in masks])).alias("mask"), F.col("_llm_print").alias("print"))
    found = None
    while True:
        keyed = members.withColumn("key", F.col("print").bitwiseAND(F.col("mask")))
        counts = keyed.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
        # With so few free bits, a group can't be larger.
        bounded = max(len(free) for free in masks.values()) <= int(np.log2(largest))
        crowded = None if bounded else checkpointed(counts.where(F.col("members") > largest))
        if crowded is not None and crowded.isEmpty():
            crowded = None
        if crowded is not None:
            keyed = checkpointed(keyed)
            fit = match_keyed(keyed, crowded.select("mask", "key"), ["mask", "key"], "left_anti")
        else:
            fit = keyed
        groups = fit.groupBy("mask", "key").agg(F.collect_list("print").alias("group")).where(F.size("group") > 1)
        here = groups.select(F.explode(compare("group")).alias("link")).select("link.a", "link.b")
        found = here if found is None else found.unionByName(here)
        if crowded is None:
            return found
        children, masks = next_masks(masks, radius)
        pairs = prints.sparkSession.createDataFrame([(m, c) for m, more in children.items() for c in more], "mask long, child long")
        again = match_keyed(keyed, crowded.select("mask", "key"), ["mask", "key"], "left_semi")
        # The radius and ``largest`` alone decide how many masks there are.
        members = again.join(F.broadcast(pairs), "mask").select(F.col("child").alias("mask"), "print")


def near_duplicates(
    df: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    text: str = "text",
    doc_id: str = "doc_id",
    carry: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id its row is linked to.

    Rows are kept with their fingerprints while links are found; ``carry`` names
    the columns to keep, so that texts can be left behind.
    """
    names = df.columns if carry is None else carry
    rows = with_fingerprints(df, shingle, text)
    rows = checkpointed(rows.select(*[F.col(f"`{name}`") for name in names], "_llm_print"))
    return _with_components(rows, radius, doc_id).drop("_llm_print", "_llm_root")


def _with_components(rows: DataFrame, radius: int, doc_id: str) -> DataFrame:
    prints = checkpointed(rows.groupBy("_llm_print").agg(F.min(F.col(f"`{doc_id}`")).alias("_llm_least")))
    found = components(links(prints, radius)).withColumnsRenamed({"node": "_llm_print", "root": "_llm_root"})
    rooted = prints.join(found, "_llm_print", "left").select(
        "_llm_print", "_llm_least", F.coalesce("_llm_root", "_llm_print").alias("_llm_root")
    )
    least = rooted.groupBy("_llm_root").agg(F.min("_llm_least").alias("_llm_component"))
    classes = match_keyed(rooted.drop("_llm_least"), least, ["_llm_root"], "inner")
    joined = match_keyed(rows, classes, ["_llm_print"], "inner")
    return with_columns(
        joined,
        {"fingerprint": F.lower(F.lpad(F.hex("_llm_print"), 16, "0")), "component_id": F.col("_llm_component")},
    ).drop("_llm_component")


def without_near_duplicates(
    df: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id.

    Among rows with that id it is the one whose columns hash lowest, and of
    wholly equal rows the first.  ``df`` must be a stored table: its rows have to
    come in the same order each time they are read.
    """
    others = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    numbered = with_columns(df, {"_llm_hash": others, "_llm_number": F.monotonically_increasing_id()})
    rows = checkpointed(
        with_fingerprints(numbered, shingle, text).select(F.col(f"`{doc_id}`").alias("id"), "_llm_hash", "_llm_number", "_llm_print")
    )
    place = F.struct(F.col("id").isNull(), "id", "_llm_hash", "_llm_number")
    placed = _with_components(rows, radius, "id").withColumn("_llm_place", place)
    first = placed.groupBy("_llm_root").agg(F.min("_llm_place").alias("_llm_first"))
    dropped = match_keyed(placed, first, ["_llm_root"], "inner").where(~F.col("_llm_place").eqNullSafe(F.col("_llm_first")))
    kept = match_keyed(numbered, dropped.select("_llm_hash", "_llm_number"), ["_llm_hash", "_llm_number"], "left_anti")
    return kept.drop("_llm_hash", "_llm_number")
