"""Runs of words that repeat with a period, and texts with each run cut to one period.

A run is a stretch of words of which those a period apart are equal, as long as
it can be, at least ``exponent`` periods and ``least`` words long; its period is the
smallest.  Runs are enumerated on a harmonic grid: for a period q every stretch
looked for has at least ``exponent - 1`` periods of starts i with word i equal to word
i + q, so it is enough to look at every such multiple of q, which makes about
``n log n / (exponent - 1)`` places for n words.  From a place that fits, the longest common
extension (LCE) of the words behind i and i + q, and the one of those in front,
give the whole stretch.

LCEs come from a difference cover: of any 31 neighbouring places six are
samples, so chosen that for any two places there is a shift below 31 that
takes both to samples.  Only suffixes at samples are sorted, by their first 31
words and then by doubling, of which each round touches ties alone.  An LCE compares
words one by one up to the shift; beyond it, it is the least common prefix between
two ranks, from a sparse table.

A task works through loads of texts of some megabytes, each as one array of word
numbers with a number of its own between texts, so nothing matches across them
and short texts cost no calls of their own.

Defined results: a NULL or empty text has no words and no runs; of stretches with
several periods the smallest counts, and equal stretches are one run.  Rows
are judged one by one, so repeated rows get the same result; an empty
table gives no rows.  A long text is a load of its own, of about 200 bytes of memory a word.  Further
columns are kept, clashing names give way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import loads, modest_batches, whole_text, with_columns

#: A perfect difference set: each number below 31 is a difference of two of these six, modulo 31.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
LOAD_BYTES = 2_000_000
#: Places of the grid that are looked at in one go.
BLOCK = 1_000_000
LEAST, EXPONENT = 6, 4


def _shift_targets() -> np.ndarray:
    """For each difference of two places the sampled remainder to which the first one goes."""
    target = np.zeros(MODULUS, np.int64)
    for a in COVER:
        for b in COVER:
            target[(b - a) % MODULUS] = a
    return target


class Extensions:
    """Longest common extensions to the right, between places of one array of numbers.

    The array must end in a number that nothing else in it equals.
    """

    _TARGET = _shift_targets()

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, words.dtype)])
        n = len(words)
        self.place = np.flatnonzero(np.isin(np.arange(MODULUS), COVER)[np.arange(n) % MODULUS])
        self.sample = np.full(n + 1, -1, np.int32)
        self.sample[self.place] = np.arange(len(self.place), dtype=np.int32)
        self._sort()

    def _sort(self) -> None:
        """Order of the sampled suffixes; ``ranks`` tell which agree in 31, 62, 124 .. words."""
        bits = int(self.words.max(initial=1)).bit_length()
        each = max(1, 63 // bits)
        m = len(self.place)
        self.order = np.arange(m)
        rank = np.zeros(m, np.int32)
        for at in range(0, MODULUS, each):
            if not self._refine(rank, lambda members, at=at: self._packed(members, at, min(each, MODULUS - at), bits)):
                break
        ranks, length = [rank.copy()], MODULUS
        while self._refine(rank, lambda members, length=length: ranks[-1][self.sample[self.place[members] + length]]):
            ranks.append(rank.copy())
            length *= 2
        self.rank = np.empty(m, np.int64)
        self.rank[self.order] = np.arange(m)
        self._prefixes(ranks)

    def _packed(self, members: np.ndarray, at: int, count: int, bits: int) -> np.ndarray:
        key = np.zeros(len(members), np.int64)
        for step in range(count):
            key = (key << bits) | self.words[self.place[members] + at + step]
        return key

    def _refine(self, rank: np.ndarray, key_of) -> bool:
        """Sort ties by a further key; False where there are none.  A rank is the first slot of its ties."""
        sorted_ranks = rank[self.order]
        tied = sorted_ranks[1:] == sorted_ranks[:-1]
        slots = np.flatnonzero(np.r_[False, tied] | np.r_[tied, False]) if len(tied) else np.zeros(0, np.int64)
        if not len(slots):
            return False
        members = self.order[slots]
        key = key_of(members)
        by = np.lexsort((key, rank[members]))
        members, key = members[by], key[by]
        old = rank[members]
        first = np.r_[True, (old[1:] != old[:-1]) | (key[1:] != key[:-1])]
        self.order[slots] = members
        rank[members] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        return True

    def _prefixes(self, ranks: list[np.ndarray]) -> None:
        """Common prefixes of neighbours in the order, and their least over 1, 2, 4 .. neighbours."""
        left, right = self.place[self.order[:-1]], self.place[self.order[1:]]
        common = np.zeros(len(left), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            a, b = self.sample[left + common], self.sample[right + common]
            common[ranks[level][a] == ranks[level][b]] += MODULUS << level
        common += self._compared(left + common, right + common, np.full(len(left), MODULUS))
        self.least = [common.astype(np.int32)]
        while 2 << (len(self.least) - 1) <= len(common):
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _compared(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from ``left`` and ``right`` on, at most ``most``."""
        equal = most.copy()
        alive = np.flatnonzero(most > 0)
        a, b, end = left[alive], right[alive], most[alive]
        step = 0
        while len(alive):
            same = self.words[a + step] == self.words[b + step]
            equal[alive[~same]] = step
            step += 1
            on = same & (end > step)
            alive, a, b, end = alive[on], a[on], b[on], end[on]
        return equal

    def lengths(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from ``left`` and from ``right`` on are equal; the two are different places."""
        shift = (self._TARGET[(right - left) % MODULUS] - left) % MODULUS
        found = self._compared(left, right, shift)
        far = np.flatnonzero(found == shift)
        if len(far):
            a = self.rank[self.sample[left[far] + shift[far]]]
            b = self.rank[self.sample[right[far] + shift[far]]]
            low, span = np.minimum(a, b), np.abs(a - b)
            level = np.frexp(span.astype(np.float64))[1] - 1  # 2 ** level <= span
            for one in np.unique(level).tolist():
                here = np.flatnonzero(level == one)
                table = self.least[one]
                found[far[here]] += np.minimum(table[low[here]], table[low[here] + span[here] - (1 << one)])
        return found


def grid(starts: np.ndarray, counts: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) over all texts in blocks: for each period, every ``exponent - 1`` periods of a text."""
    most = np.where(counts >= least, counts // exponent, 0)
    text = np.repeat(np.arange(len(counts)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    stride = (exponent - 1) * period
    places = (counts[text] - 1 - period) // stride + 1
    ends = np.cumsum(places)
    at = 0
    while at < len(text):
        # A period of a very long text may have more places than a block; it is then a block of its own.
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
        times = places[at:stop]
        number = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        owner = np.repeat(np.arange(at, stop), times)
        yield starts[text[owner]] + number * stride[owner], period[owner]
        at = stop


def runs_of(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, least: int = LEAST, exponent: int = EXPONENT):
    """(start, length, period) of all runs, sorted by start, then period.

    ``words`` holds texts at ``starts`` with ``counts`` words; a number that occurs
    nowhere else stands before, between and behind them.
    """
    n = len(words)
    ahead = back = None
    found = [np.zeros((0, 3), np.int64)]
    for place, period in grid(starts, counts, least, exponent):
        fits = words[place] == words[place + period]
        place, period = place[fits], period[fits]
        if exponent >= 3 and least >= 5:
            # A stretch has four starts or more, so two more lie behind a place or in front of it.
            last = n - 1 - period

            def next_to(step: int, place=place, period=period, last=last) -> np.ndarray:
                at = np.clip(place + step, 0, last)
                return words[at] == words[at + period]

            near = (next_to(1) & next_to(2)) | (next_to(-1) & next_to(-2))
            place, period = place[near], period[near]
        if not len(place):
            continue
        if ahead is None:
            ahead, back = Extensions(words), Extensions(words[::-1])
        right = ahead.lengths(place, place + period)
        left = back.lengths(n - place, n - place - period)
        length = left + right + period
        long = length >= np.maximum(least, exponent * period)
        found.append(np.stack([place - left, length, period], axis=1)[long])
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    same = (every[1:, :2] == every[:-1, :2]).all(axis=1)
    every = every[np.r_[True, ~same][: len(every)]]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


class Load:
    """Some texts as one array of word numbers."""

    def __init__(self, texts: list[bytes]):
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        self.split = [text.split() for text in texts]
        self.counts = np.array([len(words) for words in self.split], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts + np.arange(1, len(texts) + 1)
        self.words = np.empty(int(self.counts.sum()) + len(texts) + 1, np.int64)
        for start, words in zip(self.starts.tolist(), self.split, strict=True):
            self.words[start : start + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.words[np.r_[0, self.starts + self.counts]] = len(number) + np.arange(len(texts) + 1)

    def runs(self, least: int, exponent: int) -> np.ndarray:
        return runs_of(self.words, self.starts, self.counts, least, exponent)

    def collapsed(self, runs: np.ndarray) -> list[bytes]:
        """The texts without the words behind the first period of a run."""
        steps = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
        np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
        gone = np.cumsum(steps) > 0
        kept = []
        for start, words in zip(self.starts.tolist(), self.split, strict=True):
            out = gone[start : start + len(words)]
            kept.append(b" ".join(np.array(words, object)[~out].tolist() if out.any() else words))
        return kept


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(df: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with ``runs``, an array of (start, length, period) by start and period, and ``collapsed``.

    Starts count words from 0; ``collapsed`` has the words left, joined by blanks.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has two periods at least")

    @F.arrow_udf("struct<runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in loads(batches, LOAD_BYTES):
            load = Load([text.encode() for text in texts.to_pylist()])
            runs = load.runs(least, exponent)
            owner = np.searchsorted(load.starts, runs[:, 0], side="right") - 1
            offsets = np.searchsorted(owner, np.arange(len(load.starts) + 1)).astype(np.int32)
            columns = [pa.array(runs[:, 0] - load.starts[owner]), pa.array(runs[:, 1].copy()), pa.array(runs[:, 2].copy())]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
            yield pa.StructArray.from_arrays([lists, pa.array(load.collapsed(runs), pa.binary()).cast(pa.string())], ["runs", "collapsed"])

    done = with_columns(modest_batches(df), {"_llm_found": found.asNondeterministic()(whole_text(text))})
    return with_columns(done, {name: F.col(f"_llm_found.{name}") for name in ("runs", "collapsed")}).drop("_llm_found")
