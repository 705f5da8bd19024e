"""Suffix arrays by induced sorting, and permuted longest common prefixes, in vector operations.

Suffixes are classified as smaller or larger than their successor. The leftmost-smaller substrings are sorted by one
round of induction and named by rank; unless the names are unique, the string of names is sorted by the same routine,
down to the length where ranks of prefixes of doubling length end the recursion;
from the sorted leftmost-smaller suffixes all others are induced in two passes. A pass takes buckets in order, and as
many at a time as do not induce into one another, so that the work is linear and mostly in large steps.
"""

from __future__ import annotations

import numpy as np

MOST_BUCKETS = 1 << 14
# The recursion ends at strings of names of this length, which are sorted by doubling their ranks: going on to 512 names
# gives the same arrays and takes a seventh longer.
SHORT = 1 << 16
_ZERO = np.zeros(1, np.int64)


def _smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor; equal neighbours share the type of the next change."""
    change = np.flatnonzero(s[:-1] != s[1:])
    if not len(change):
        return np.r_[np.zeros(len(s) - 1, bool), True]
    rises = s[change] < s[change + 1]
    at = np.searchsorted(change, np.arange(len(s) - 1))
    return np.r_[rises[np.minimum(at, len(change) - 1)], True]


def _put(sa: np.ndarray, free: np.ndarray, symbols: np.ndarray, values: np.ndarray, step: int) -> None:
    """Put values into the buckets of their symbols, in order, moving the free places by `step` each time."""
    n = len(values)
    if n < 3:
        for symbol, value in zip(symbols, values):
            sa[free[symbol]] = value
            free[symbol] += step
        return
    order = symbols.argsort(kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(ranked[1:] != ranked[:-1])
    first += 1
    first = np.concatenate([_ZERO, first])
    count = np.empty_like(first)
    count[:-1] = first[1:] - first[:-1]
    count[-1] = n - first[-1]
    each = ranked[first]
    base = free[each]
    if step > 0:
        place = np.arange(n) + (base - first).repeat(count)
        free[each] = base + count
    else:
        place = (base + first).repeat(count) - np.arange(n)
        free[each] = base - count
    sa[place] = values[order]


def _induce(s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the order of the leftmost-smaller suffixes `lms`."""
    n, k = len(s), len(starts) - 1
    sa = np.full(n, -1, np.int32)
    in_bucket = np.bincount(s[lms], minlength=k)
    tail = starts[1:] - in_bucket
    _put(sa, tail.copy(), s[lms], lms, 1)
    head = starts[:-1].copy()
    c, width = 0, 1
    while c < k:
        if width == 1:
            at = starts[c]
            while at < head[c]:  # larger ones, and those of the same symbol that they bring in
                upto = head[c]
                _larger(s, smaller, sa, head, sa[at:upto])
                at = upto
            _larger(s, smaller, sa, head, sa[tail[c] : starts[c + 1]])
            c, width = c + 1, 2
            continue
        end = min(k, c + width)
        source = sa[starts[c] : starts[end]]
        source = source[source > 0]
        before = source - 1
        before = before[~smaller[before]]
        symbols = s[before]
        inside = symbols < end
        if inside.any():
            cut = int(symbols[inside].min())
            width = max(1, cut - c)
            continue
        _put(sa, head, symbols, before, 1)
        c, width = end, min(2 * width, MOST_BUCKETS)
    # Only the larger ones stay; the smaller ones are put in again from the right.
    keep = np.zeros(n, bool)
    keep[sa >= 0] = ~smaller[sa[sa >= 0]]
    sa[~keep] = -1
    sa[0] = n - 1
    free = starts[1:] - 1
    free[0] = -1
    c, width = k, 1
    while c > 0:
        if width == 1:
            b = c - 1
            at = starts[c] - 1
            while at > free[b]:
                downto = free[b]
                _lesser(s, smaller, sa, free, sa[downto + 1 : at + 1][::-1])
                at = downto
            _lesser(s, smaller, sa, free, sa[starts[b] : head[b]][::-1])
            c, width = b, 2
            continue
        start = max(0, c - width)
        source = sa[starts[start] : starts[c]][::-1]
        source = source[source > 0]
        before = source - 1
        before = before[smaller[before]]
        symbols = s[before]
        inside = symbols >= start
        if inside.any():
            cut = int(symbols[inside].max())
            width = max(1, c - 1 - cut)
            continue
        _put(sa, free, symbols, before, -1)
        c, width = start, min(2 * width, MOST_BUCKETS)
    return sa


def _larger(s: np.ndarray, smaller: np.ndarray, sa: np.ndarray, head: np.ndarray, source: np.ndarray) -> None:
    before = source[source > 0] - 1
    before = before[~smaller[before]]
    _put(sa, head, s[before], before, 1)


def _lesser(s: np.ndarray, smaller: np.ndarray, sa: np.ndarray, free: np.ndarray, source: np.ndarray) -> None:
    before = source[source > 0] - 1
    before = before[smaller[before]]
    _put(sa, free, s[before], before, -1)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, in the order of `ordered`: equal substrings share one."""
    end = np.full(len(s), -1, np.int32)
    end[lms[:-1]] = lms[1:]
    end[lms[-1]] = lms[-1]
    length = end[ordered] - ordered
    a, b = ordered[:-1], ordered[1:]
    same = length[:-1] == length[1:]
    open_ = np.flatnonzero(same)
    at = 0
    while len(open_):
        alike = s[a[open_] + at] == s[b[open_] + at]
        same[open_[~alike]] = False
        at += 1
        open_ = open_[alike]
        open_ = open_[length[open_] >= at]
    return np.r_[0, np.cumsum(~same)].astype(np.int32)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Of an array of numbers from 0 up whose last one is 0 and whose others are not."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    # Small symbols are sorted digit by digit.
    s = s.astype(np.uint8 if s.max() < 256 else np.uint16 if s.max() < 65536 else np.int32)
    smaller = _smaller(s)
    starts = np.r_[0, np.cumsum(np.bincount(s))].astype(np.int64)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    rough = _induce(s, smaller, starts, lms)
    ordered = rough[is_lms[rough]]
    names = _names(s, lms, ordered)
    if names[-1] + 1 < len(lms):
        of = np.empty(len(s), np.int32)
        of[ordered] = names
        ordered = lms[(_doubled if len(lms) <= SHORT else suffix_array)(of[lms])]
    return _induce(s, smaller, starts, ordered)


def _doubled(names: np.ndarray) -> np.ndarray:
    """The suffix array of a short string of names, by ranks of prefixes of doubling length."""
    rank = names.astype(np.int64)
    span = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-span] = rank[span:] + 1
        pair = rank * (int(rank.max()) + 2) + after
        order = pair.argsort(kind="stable")
        ranked = pair[order]
        new = np.concatenate([_ZERO, np.cumsum(ranked[1:] != ranked[:-1])])
        rank[order] = new
        if new[-1] + 1 == len(rank):
            return order.astype(np.int32)
        span *= 2


def permuted_lcp(s: np.ndarray, order: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """For `places`, in ascending order, the longest common prefix with the suffix before each in the suffix array.

    Prefixes are in text order, where one is at most one shorter than that of the place before: comparisons go on from
    there. Places that follow one another are a row; all rows advance together. Prefixes are measured up to `most`.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([s, np.zeros(most + 8, s.dtype)]).astype(np.uint64)
    # Four symbols of 16 bits in a word.
    words = padded[:-3].copy()
    for i in range(1, 4):
        words |= padded[i : len(padded) - 3 + i] << np.uint64(16 * i)
    lcp = np.zeros(len(places), np.int64)
    row_at = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + 1])) if len(places) else np.zeros(0, np.int64)
    row_length = np.diff(np.concatenate([row_at, [len(places)]]))
    length = np.zeros(len(row_at), np.int64)
    phase = 0
    while len(row_at):
        at = places[row_at + phase]
        length = np.maximum(length - 1, 0)
        other = before[at]
        open_ = np.flatnonzero((other >= 0) & (length < most))
        while len(open_):
            there = other[open_] + length[open_]
            differ = words[at[open_] + length[open_]] ^ words[there]
            low = differ & (~differ + np.uint64(1))
            alike = np.where(differ == 0, 4, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 16)
            length[open_] += alike
            open_ = open_[(alike == 4) & (length[open_] < most)]
        length[other < 0] = 0
        length = np.minimum(length, most)
        lcp[row_at + phase] = length
        phase += 1
        more = row_length > phase
        row_at, row_length, length = row_at[more], row_length[more], length[more]
    return lcp
