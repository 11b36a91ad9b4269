"""Periodic runs of words in whole texts, by maximal pairs.

A maximal pair (i, j) is two places of a text whose words agree for exactly ``depth`` words and
differ before. Its stretch from ``i`` to ``j + depth`` has period ``j - i`` and no neighbouring
word extends it, so the maximal pairs with ``depth >= 2 * (j - i)`` are the runs of at least
three periods: nothing has to be extended. The suffixes of a text are sorted, and the intervals
of their longest common prefixes are walked bottom-up. Every interval holds its places in order,
cut into lists of places with the same word on their left; where two intervals meet at a depth,
the places of the smaller look for partners of another list within half that depth.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_WORDS = 24
PERIODS = 3
# A pair of a run agrees in at least this many words: length - period, the period at most a third.
DEPTH = LEAST_WORDS - LEAST_WORDS // PERIODS
RUN = "struct<start: long, length: long, period: long>"


def numbered(words: list[bytes]) -> np.ndarray:
    """The same number for equal words only."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(word, len(known)) for word in words], np.int64)


def may_repeat(ids: np.ndarray) -> bool:
    """Whether some ``DEPTH`` words in a row may occur twice; only a hash is compared, so a
    text without a repeat can pass, but none with one is turned away."""
    if len(ids) <= DEPTH:
        return False
    hashed, width = (ids + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while width * 2 <= DEPTH:
            hashed = hashed[:-width] ^ ((hashed[width:] ^ (hashed[width:] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
            hashed ^= hashed >> np.uint64(32)
            width *= 2
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


def sorted_suffixes(ids: np.ndarray) -> np.ndarray:
    """The places of a text in the order of the words from there on, by doubling."""
    n, width = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:]
        key = rank * (n + 2) + later
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank[order] = np.cumsum(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
        if rank[order[-1]] == n:
            return order
        width *= 2


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """Words that each suffix has in common with the one before it in order."""
    n = len(ids)
    place, found, held = [0] * n, [0] * (n + 1), 0
    for at, suffix in enumerate(order):
        place[suffix] = at
    for suffix in range(n):
        at = place[suffix]
        if not at:
            held = 0
            continue
        before = order[at - 1]
        most = n - max(suffix, before)
        while held < most and ids[suffix + held] == ids[before + held]:
            held += 1
        found[at] = held
        held = max(0, held - 1)
    return found


@dataclass
class Interval:
    """The places of an interval, and where in their order a list of another left word begins."""

    places: list[int]
    heads: list[int] = field(default_factory=list)

    def partners(self, place: int, reach: int, left: list[int]):
        """Places within ``reach`` whose left word differs from that of ``place``; lists with
        the same left word are passed over in one step."""
        places, heads = self.places, self.heads
        at, end, own = bisect_left(places, place - reach), bisect_right(places, place + reach), left[place]
        while at < end:
            found = places[at]
            if left[found] != own:
                yield found
                at += 1
            else:
                head = bisect_right(heads, found)
                if head == len(heads):
                    return
                at = bisect_left(places, heads[head], at)

    def add(self, place: int, left: list[int]) -> None:
        places, heads = self.places, self.heads
        at = bisect_left(places, place)
        before = left[places[at - 1]] if at else None
        if at < len(places):
            after, own = places[at], left[places[at]]
            if (own != before) != (own != left[place]):
                if own != before:
                    heads.pop(bisect_left(heads, after))
                else:
                    insort(heads, after)
        if left[place] != before:
            insort(heads, place)
        places.insert(at, place)

    def take_all(self, other: "Interval", left: list[int]) -> None:
        if len(other.places) * 16 < len(self.places):
            for place in other.places:
                self.add(place, left)
            return
        self.places = sorted(self.places + other.places)
        self.heads = [p for p, before in zip(self.places, [None, *self.places]) if before is None or left[p] != left[before]]


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    if not may_repeat(ids):
        return []
    order = sorted_suffixes(ids).tolist()
    ids = ids.tolist()
    prefixes = common_prefixes(ids, order)
    left = [-1, *ids[:-1]]
    periods: dict[tuple[int, int], int] = {}

    def joined(one: Interval, two: Interval, depth: int) -> Interval:
        large, small = (one, two) if len(one.places) >= len(two.places) else (two, one)
        for place in small.places:
            for other in large.partners(place, depth // (PERIODS - 1), left):
                first, period = min(place, other), abs(place - other)
                length = period + depth
                # A stretch is found at each multiple of its period that fits; the least counts.
                if length >= LEAST_WORDS and periods.get((first, length), period) >= period:
                    periods[first, length] = period
        large.take_all(small, left)
        return large

    waiting: list[tuple[int, Interval]] = []
    for at, suffix in enumerate(order):
        depth = prefixes[at + 1]
        if depth < DEPTH and not waiting:
            continue
        here = Interval([suffix], [suffix])
        while waiting and waiting[-1][0] > depth:
            below, interval = waiting.pop()
            here = joined(interval, here, below)
        if depth < DEPTH:
            continue  # intervals above are too shallow for any run
        if waiting and waiting[-1][0] == depth:
            here = joined(waiting.pop()[1], here, depth)
        waiting.append((depth, here))
    return sorted((start, length, period) for (start, length), period in periods.items())


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if found:
        covered = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            covered[start + period] += 1
            covered[start + length] -= 1
        words = [words[at] for at in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
    return b" ".join(words)


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equals the smallest start, then period."""
    return max(found, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)


def periodic_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``runs``, an array of (start, length, period) in words by start and
    then period, ``strongest_run`` (null if there is none) and ``collapsed``, the text without
    the repetitions.

    Words are what ASCII white space parts, compared as they are. A run is a stretch of words
    with smallest period ``period`` that no neighbouring word extends, at least ``LEAST_WORDS``
    words and ``PERIODS`` periods long. A null or empty text has no runs and an empty collapsed
    text. Rows are worked on one by one, so equal rows, ties and null ids change nothing; whole
    texts are read, of any length, with memory in proportion to one text; columns of the input
    with the names of the new ones, in any case, are replaced; an empty table gives no rows.
    """
    made = {"runs": f"array<{RUN}>", "strongest_run": RUN, "collapsed": "string"}
    names = [c for c in documents.columns if c.lower() not in made]
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    as_run = lambda r: None if r is None else {"start": r[0], "length": r[1], "period": r[2]}

    def found(batches):
        for batch in batches:
            all_runs, strong, left = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                of_text = runs(numbered(words)) if len(words) >= LEAST_WORDS else []
                all_runs.append([as_run(r) for r in of_text])
                strong.append(as_run(strongest(of_text)))
                left.append(collapsed(words, of_text))
            new = [pa.array(all_runs, pa.list_(run)), pa.array(strong, run), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], *new], [*names, *made])

    fields = [f"`{n}` {t}" for n, t in documents.dtypes if n in names]
    return documents.mapInArrow(found, ", ".join([*fields, *[f"{n} {t}" for n, t in made.items()]]))
