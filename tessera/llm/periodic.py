"""Periodic runs of words by a sparse diagonal DP.

Lag q's diagonal pairs each word with the word q places earlier. A stretch of
length L has period q exactly where diagonal q matches L - q times in a row, so a
run (smallest period q, length >= max(12, 2 q), not extendable) is one maximal
streak of at least max(q, 12 - q) matches.

1. Anchors. Every such streak holds a repeated gram of 6 words, so texts without
   one end here. For q < 6 the few diagonals are read whole. For q >= 6, levels
   g = 6, 12, 24, ... look at grams of g words for lags g <= q < 2 g: the earlier
   occurrences of a gram name the diagonals that are active at its place.
2. Sparse occurrences. Where a gram occurs again within half its own length, the
   text has a smaller period there, and a longer run that is still of interest
   must begin or end in that neighbourhood: only the first occurrence in each
   such neighbourhood looks back (over all earlier occurrences of its window).
   This names every run at least once with O(n) places a level, also in texts
   that repeat one word throughout.
3. Online DP. The named places are read in text order; places that follow each
   other on one diagonal raise its match length. A place inside a streak that is
   already counted is skipped; else the streak is followed word by word to both
   ends, and as soon as it ends with enough matches its run is emitted. Stretches
   found with a multiple of their period share start and end with the run of the
   smallest period, which is the one kept.

Grams are ranked exactly (no hashes), so nothing is missed or made up. A text is
one row, handled alone in its task; memory is a few integers a word.

Defined results: null and texts without words have no runs and an empty collapsed
text; words are what stands between ASCII white space, compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.llm.common import utf8

MIN_LENGTH = 12
GRAM = MIN_LENGTH // 2  # every streak of matches holds a gram of so many words
RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
DDL = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, int]:
    """The words as numbers, equal for equal words, and how many there are."""
    table = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(table.__getitem__, words), np.int64, len(words)), len(table)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys (equal ones by place) and each sorted key's rank."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])


def _first_grams(ids: np.ndarray, vocabulary: int) -> np.ndarray:
    """A key for the gram of ``GRAM`` words that ends at each place from GRAM - 1 on."""
    bits = max(1, int(vocabulary - 1).bit_length())
    step = GRAM if bits * GRAM <= 62 else GRAM // 2
    n = len(ids) - step + 1
    keys = np.zeros(n, np.int64)
    for at in range(step):
        keys = (keys << bits) | ids[at : at + n]
    if step < GRAM:
        order, rank = _ranks(keys)
        halves = np.empty(n, np.int64)
        halves[order] = rank
        keys = halves[: n - step] * n + halves[step:]
    return keys


def _named(places: np.ndarray, order: np.ndarray, rank: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the diagonals with lags of ``gram`` to 2 ``gram`` - 1."""
    at = places[order]
    same = rank[1:] == rank[:-1]
    first = np.concatenate([[True], ~(same & (2 * np.diff(at) <= gram))])
    width = int(places[-1]) + 1
    keys = rank * width + at
    base, place = rank[first] * width, at[first]
    low = np.searchsorted(keys, base + np.maximum(place - 2 * gram + 1, 0))
    high = np.where(place >= gram, np.searchsorted(keys, base + np.maximum(place - gram, 0), "right"), low)
    size = np.maximum(high - low, 0)
    source = np.repeat(np.arange(len(place)), size)
    earlier = at[np.repeat(low - np.cumsum(size) + size, size) + np.arange(len(source))]
    return place[source], place[source] - earlier


def _until(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """The last place of the streak of matches on diagonal ``lag`` from ``at`` on
    (``step`` 1), or its first place back from ``at`` (``step`` -1)."""
    size = 32
    while True:
        if step > 0:
            now = ids[at + 1 : at + 1 + size]
            apart = np.flatnonzero(now != ids[at + 1 - lag : at + 1 - lag + len(now)])
        else:
            low = max(lag, at - size)
            now = ids[low:at][::-1]
            apart = np.flatnonzero(now != ids[low - lag : at - lag][::-1])
        if len(apart):
            return at + step * int(apart[0])
        at += step * len(now)
        if len(now) < size:
            return at
        size *= 4


def find_runs(ids: np.ndarray, vocabulary: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    n = len(ids)
    if n < MIN_LENGTH:
        return []
    keys = _first_grams(ids, vocabulary)
    in_order = np.sort(keys)
    if not (in_order[1:] == in_order[:-1]).any():
        return []
    smallest: dict[tuple[int, int], int] = {}  # (start, end): period

    def emit(first: int, last: int, lag: int) -> None:
        if last - first + 1 >= max(lag, MIN_LENGTH - lag):
            span = (first - lag, last)
            smallest[span] = min(lag, smallest.get(span, lag))

    for lag in range(1, min(GRAM, n)):
        ends = np.concatenate([[lag - 1], lag + np.flatnonzero(ids[lag:] != ids[:-lag]), [n]])
        for i in np.flatnonzero(np.diff(ends) > MIN_LENGTH - lag):
            emit(int(ends[i]) + 1, int(ends[i + 1]) - 1, lag)

    segments = []
    gram, places = GRAM, np.arange(GRAM - 1, n)
    while len(places) and 2 * gram <= n:
        order, rank = _ranks(keys)
        place, lag = _named(places, order, rank, gram)
        if len(place):
            by = np.lexsort((place, lag))
            place, lag = place[by], lag[by]
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(lag) != 0)]))
            ends = np.concatenate([begins[1:], [len(place)]]) - 1
            segments += zip(place[begins].tolist(), place[ends].tolist(), lag[begins].tolist(), [gram] * len(begins), strict=True)
        # The next level: grams twice as long, where both halves occur more than once.
        number = np.full(n, -1, np.int64)
        size = np.bincount(rank)
        number[places[order]] = np.where(size[rank] > 1, rank, -1)
        places = places[places >= 2 * gram - 1]
        left, right = number[places - gram], number[places]
        both = (left >= 0) & (right >= 0)
        places, keys = places[both], left[both] * n + right[both]
        gram *= 2

    counted: dict[int, int] = {}  # the last place counted on each diagonal
    for begin, end, lag, gram in sorted(segments):
        if counted.get(lag, -1) >= begin:
            continue
        last = _until(ids, end, lag, 1)
        counted[lag] = last
        emit(_until(ids, begin - gram + 1, lag, -1), last, lag)
    return sorted((start, end - start + 1, period) for (start, end), period in smallest.items())


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _of_text(data: bytes) -> dict:
    words = data.split()  # bytes: ASCII white space only
    runs = find_runs(*word_numbers(words))
    return {
        "n_words": len(words),
        "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs],
        "collapsed": b" ".join(collapse(words, runs)).decode(),
    }


def runs_column(text: Column) -> Column:
    """For each text: its number of words, its runs by start and period, and the
    text with one period of every run, its words joined by blanks."""

    @F.arrow_udf(DDL)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_of_text(data.as_py()) for data in batch], RESULT)

    return found(utf8(text))


def longest(runs: Column) -> Column:
    """The run of the greatest length; ties to the smallest start, then period."""
    order = lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))
    best = F.array_min(F.transform(runs, order))
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), (-best["n"]).alias("length"), best["period"].alias("period")))


def repeat_from(words: Column, first: Column, period: Column) -> Column:
    """An array whose elements from place ``first`` on (0 is the first) repeat the
    ``period`` elements that stand there, to the array's old length."""
    rest = F.size(words) - first
    unit = F.slice(words, first + 1, period)
    copies = F.flatten(F.array_repeat(unit, F.ceil(rest / period).cast("int")))
    return F.concat(F.slice(words, F.lit(1), first), F.slice(copies, F.lit(1), rest))
