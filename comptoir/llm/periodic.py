"""Runs of repeated words, by an enhanced suffix array and the branching-tandem test.

Of each text only stretches of words whose WINDOW-word windows all recur in that text can hold a run; these stretches of
a chunk of texts, each with an alphabet of its own, are one string. Its suffix array is sorted by prefix doubling,
its LCP array filled from the irreducible values, and its LCP intervals are listed in one pass over that array,
without tree nodes. For each interval of depth d, every suffix i outside the interval's largest child asks the inverse
array whether i + d and i - d are in the interval: if so, and the next words differ, a square ends a run there.
Squares are rotated to the left as far as words repeat, which gives each run once.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from comptoir.llm import words
from comptoir.llm.shared import widened

#: Least length of a run, in words and in periods. Any run of this length has all its WINDOW-word windows twice.
LEAST_WORDS, LEAST_PERIODS = 24, 3
WINDOW = 8
#: Bytes of a text that are split into words at once; words, intervals' suffixes and neighbours compared at once.
SLICE, SLAB = 1 << 20, 1 << 21
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Found(NamedTuple):
    """Runs of one string, by start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    begin = 0
    while begin < len(text):
        cut = _SPACE.search(text, begin + SLICE)
        end = cut.start() if cut else len(text)
        yield text[begin:end].split()
        begin = end


def _places(values: np.ndarray) -> np.ndarray:
    """For each value where its equals begin in sorted order."""
    kinds, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - count)[inverse]


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each; what follows the end is smaller than every symbol."""
    n = len(symbols)
    rank = _places(symbols)
    order = np.argsort(rank, kind="stable")
    reach = 1
    active = order[_shared(rank[order])]  # suffixes whose place is open, in order
    while len(active):
        after = active + reach
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[active]
        sort = np.argsort(first * (n + 1) + second, kind="stable")
        active, first, second = active[sort], first[sort], second[sort]
        begins = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        group = np.r_[True, first[1:] != first[:-1]]
        at = np.arange(len(active))
        place = first + at - np.maximum.accumulate(np.where(group, at, 0))
        order[place] = active
        rank[active] = place[np.maximum.accumulate(np.where(begins, at, 0))]
        active = active[_shared(rank[active])]
        reach *= 2
    return order, rank


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Which of sorted ranks another entry has, too."""
    out = np.zeros(len(ranks), bool)
    same = ranks[1:] == ranks[:-1]
    out[:-1] |= same
    out[1:] |= same
    return out


def _agreeing(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many symbols agree from a and b on, forward (step 1) or backward (step -1)."""
    n, out = len(symbols), np.zeros(len(a), np.int64)
    left, width = np.arange(len(a)), 8
    while len(left):
        more = []
        for part in np.array_split(left, max(1, len(left) * width // SLAB)):
            at = out[part][:, None] * step + np.arange(width) * step
            x, y = a[part][:, None] + at, b[part][:, None] + at
            inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < n)
            same = inside & (symbols[np.clip(x, 0, n - 1)] == symbols[np.clip(y, 0, n - 1)])
            count = np.where(same.all(1), width, same.argmin(1))
            out[part] += count
            more.append(part[count == width])
        left = np.concatenate(more)
        width = min(2 * width, 1024)
    return out


def lcp_array(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Symbols that each suffix shares with the one before it in order; 0 for the first.

    Only irreducible values are compared, those whose two suffixes follow different symbols; by text position, each other
    one is one less than its left neighbour.
    """
    n = len(symbols)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    irreducible = (before <= 0) | (at == 0)
    irreducible |= symbols[np.maximum(at - 1, 0)] != symbols[np.maximum(before - 1, 0)]
    open_ = np.flatnonzero(irreducible & (before >= 0))
    value = np.zeros(n, np.int64)
    value[open_] = _agreeing(symbols, open_, before[open_], 1)
    last = np.maximum.accumulate(np.where(irreducible, at, 0))
    return (value[last] - (at - last))[order]


def intervals(lcp: np.ndarray) -> np.ndarray:
    """Rows `left, right, depth, begin, end` of all LCP intervals of depth 1 and more; the last two bound the
    largest child. Ends are exclusive."""
    out: list[int] = []
    depth, left, child, begin, end = [0], [0], [0], [0], [0]
    x = 0
    for x, height in enumerate(itertools.chain(lcp[1:].tolist(), (0,)), 1):
        start = x - 1
        while depth[-1] > height:
            start = left.pop()
            b, e, c = begin.pop(), end.pop(), child.pop()
            if x - c > e - b:
                b, e = c, x
            out += (start, x, depth.pop(), b, e)
        if depth[-1] == height:
            if height and x - child[-1] > end[-1] - begin[-1]:
                begin[-1], end[-1] = child[-1], x
            child[-1] = x
        else:
            depth.append(height)
            left.append(start)
            child.append(x)
            begin.append(start)
            end.append(x)
    return np.array(out, np.int64).reshape(-1, 5)


def branching(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of all squares that the next word does not continue."""
    n = len(symbols)
    ended = np.append(symbols, -1)  # past the end
    size = table[:, 1] - table[:, 0] - (table[:, 4] - table[:, 3])
    starts, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    bounds = np.unique(np.r_[0, np.searchsorted(np.cumsum(size), np.arange(SLAB, int(size.sum()) + SLAB, SLAB), "right"), len(table)])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        part = table[a:b]
        count = np.stack([part[:, 3] - part[:, 0], part[:, 1] - part[:, 4]], 1).ravel()
        place = words.gather(np.stack([part[:, 0], part[:, 4]], 1).ravel(), count)
        of = np.repeat(np.arange(2 * len(part)) // 2, count)
        low, high, depth = part[of, 0], part[of, 1], part[of, 2]
        i = order[place]
        for begin in (i, i - depth):
            other = i + depth if begin is i else begin
            inside = (other >= 0) & (other < n)
            at = rank[np.clip(other, 0, n - 1)]
            inside &= (at >= low) & (at < high)
            inside &= ended[np.clip(begin + depth, 0, n)] != ended[np.clip(begin + 2 * depth, 0, n)]
            starts.append(begin[inside])
            periods.append(depth[inside])
    start, period = np.concatenate(starts), np.concatenate(periods)
    both = np.unique(start * (n + 1) + period)
    return both // (n + 1), both % (n + 1)


def rotated(symbols: np.ndarray, start: np.ndarray, period: np.ndarray) -> Found:
    """Runs of the squares: each is rotated to the left; squares of a multiple of a run's period are part of it."""
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    runs: list[np.ndarray] = []
    open_ = np.ones(len(start), bool)
    while open_.any():
        at = np.flatnonzero(open_)
        first = at[np.r_[True, end[at][1:] != end[at][:-1]]]  # the least period of each end
        back = _agreeing(symbols, start[first] - 1, start[first] - 1 + period[first], -1)
        run = np.stack([start[first] - back, end[first], period[first]], 1)
        runs.append(run)
        of = np.searchsorted(end[first], end[at])
        part = (start[at] >= run[of, 0]) & (period[at] % run[of, 2] == 0)
        open_[at[part]] = False
    run = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
    run = run[np.lexsort((run[:, 2], run[:, 0]))]
    return Found(run[:, 0], run[:, 1] - run[:, 0], run[:, 2])


def maximal_runs(symbols: np.ndarray) -> Found:
    """All maximal runs of at least two periods, each with its smallest period."""
    if len(symbols) < 2:
        return Found(*(np.empty(0, np.int64),) * 3)
    order, rank = suffix_array(symbols)
    return rotated(symbols, *branching(symbols, order, rank, intervals(lcp_array(symbols, order, rank))))


def stretches(numbers: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the longest stretches of words whose windows all recur in their own text.

    Windows are compared by fingerprint: one too many only makes a stretch longer.
    """
    keys, first = words.windows(words.mix(numbers.view(np.uint64)), row, WINDOW)
    keys = words.mix(keys ^ words.mix(row[first].astype(np.uint64)))
    order = np.argsort(keys)
    again = np.zeros(len(numbers), bool)
    again[first[order[_shared(keys[order])]]] = True
    edge = np.flatnonzero(np.diff(np.r_[False, again, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2] + WINDOW - 1
    if len(begin):  # stretches of one text that overlap are one
        apart = np.r_[True, (begin[1:] > end[:-1]) | (row[begin[1:]] != row[begin[:-1]])]
        begin, end = begin[apart], end[np.r_[np.flatnonzero(apart)[1:] - 1, len(end) - 1]]
    return begin, end


def long_runs(numbers: np.ndarray, row: np.ndarray, least_words: int, least_periods: int) -> tuple[np.ndarray, Found]:
    """The runs of all texts whose words are numbered in `numbers`, and the text of each; starts are indices of `numbers`."""
    if least_words >= 3 * WINDOW - 5 and least_periods >= 3:
        begin, end = stretches(numbers, row)
    else:  # shorter runs need not repeat a window
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
        end = np.append(begin[1:], len(row)) if len(row) else begin
    size = end - begin
    at = words.gather(begin, size)
    _, symbols = np.unique(np.stack([np.repeat(np.arange(len(begin)), size), numbers[at]]), axis=1, return_inverse=True)
    found = maximal_runs(symbols.ravel())
    keep = found.length >= np.maximum(least_words, least_periods * found.period)
    found = Found(at[found.start[keep]], found.length[keep], found.period[keep])
    return row[found.start], found


def collapsed(docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """The same rows and columns with `n_words, runs, collapsed`.

    Words are separated by white space of ASCII. `runs` are structs `start, length, period` (long), by start, then
    period: stretches of words with that smallest period that no neighbouring word continues, of at least `least_words` words
    and `least_periods` periods (2 at least). `collapsed` are the words that stay if each run keeps only its first period: a
    word is dropped if any run holds it after that; they are joined by one space. A null or empty text has no words. Columns
    named like the new ones are replaced. Rows are independent of each other; nothing is shuffled.

    A long text is a chunk of its own; it needs about 100 bytes a word of its repeating stretches.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")
    added = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    kept = docs.drop("n_words", "runs", "collapsed")
    at_text = kept.columns.index(text)

    def scanned(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for first, last, data, offsets in words.chunks(batch.column(at_text)):
                raw = [data[a:b].tobytes() for a, b in itertools.pairwise(offsets.tolist())]
                number: dict[bytes, int] = defaultdict(itertools.count().__next__)
                numbers = [np.fromiter(map(number.__getitem__, part), np.int64, len(part)) for x in raw for part in slices(x)]
                count = np.zeros(len(raw), np.int64)
                parts = [k for k, x in enumerate(raw) for _ in slices(x)] if any(len(x) > SLICE for x in raw) else [
                    k for k, x in enumerate(raw) if x]
                np.add.at(count, parts, [len(x) for x in numbers])
                flat = np.concatenate([np.empty(0, np.int64), *numbers])
                begin = np.cumsum(count) - count
                of, found = long_runs(flat, np.repeat(np.arange(len(raw)), count), least_words, least_periods)
                drop = np.zeros(len(flat), bool)
                drop[words.gather(found.start + found.period, found.length - found.period)] = True
                held = np.bincount(of, minlength=len(raw))
                left = [_left(x, drop[b:b + n] if h else None) for x, b, n, h in zip(
                    raw, begin.tolist(), count.tolist(), held.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, last - first).columns, pa.array(count, pa.int64()),
                     pa.ListArray.from_arrays(
                         pa.array(np.r_[0, np.cumsum(held)], pa.int32()),
                         pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (
                             found.start - begin[of], found.length, found.period)], ["start", "length", "period"])),
                     pa.array(left, pa.string())],
                    [*batch.schema.names, "n_words", "runs", "collapsed"])

    return widened(kept, scanned, added)


def _left(text: bytes, drop: np.ndarray | None) -> str:
    if drop is None:
        return b" ".join(b" ".join(part) for part in slices(text) if part).decode()
    out, at = [], 0
    for part in slices(text):
        out += itertools.compress(part, (~drop[at:at + len(part)]).tolist())
        at += len(part)
    return b" ".join(out).decode()
