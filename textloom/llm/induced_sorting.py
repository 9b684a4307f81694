"""Suffix arrays by induced sorting, and permuted common-prefix lengths, in numpy.

The scan that induces one suffix from another goes bucket by bucket; what a bucket holds already is
induced in one vector step, and what that adds to the same bucket in the next.
"""

from __future__ import annotations

import numpy as np

#: Names of LMS substrings are sorted by recursion while their alphabet is at most this; with more names
#: than that a scan by bucket has no vectors to work on, and they are ranked by doubling.
RECURSE_ALPHABET = 1024


def _stably_dealt(symbols: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts symbols stably, each sorted item's place among its equals, and the counts."""
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=alphabet)
    firsts = np.cumsum(counts) - counts
    return order, np.arange(len(symbols)) - firsts[symbols[order]], counts


def _induce(text: np.ndarray, small: np.ndarray, lms_in_order: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array that the given order of LMS suffixes induces."""
    sizes = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.full(len(text), -1, np.int64)
    symbols = text[lms_in_order]
    order, place, lms = _stably_dealt(symbols, alphabet)
    out[(ends - lms)[symbols[order]] + place] = lms_in_order[order]

    head = starts.copy()

    def put(items: np.ndarray, pointer: np.ndarray, wanted: bool, sign: int) -> None:
        before = items[items > 0] - 1
        before = before[small[before] == wanted]
        if not len(before):
            return
        order, place, counts = _stably_dealt(text[before], alphabet)
        before = before[order]
        out[pointer[text[before]] + sign * place] = before
        pointer += sign * counts

    filled = np.flatnonzero(sizes)
    for c in filled:
        done = starts[c]
        while done < head[c]:
            items, done = out[done : head[c]], head[c]
            put(items, head, False, 1)
        if lms[c]:
            put(out[ends[c] - lms[c] : ends[c]], head, False, 1)
    tail = ends - 1
    for c in filled[::-1]:
        large_end = head[c]
        out[large_end : ends[c]] = -1
    for c in filled[::-1]:
        done = ends[c] - 1
        while done > tail[c]:
            items, done = out[tail[c] + 1 : done + 1][::-1], tail[c]
            put(items, tail, True, -1)
        if head[c] > starts[c]:
            put(out[starts[c] : head[c]][::-1], tail, True, -1)
    out[0] = len(text) - 1  # nothing induces the last suffix, the smallest
    return out


def _ranked_by_doubling(names: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of names; the last name must be the only one of its kind and the smallest."""
    rank, width = names.astype(np.int64), 1
    while True:
        _, rank = np.unique(rank, return_inverse=True)
        if int(rank.max(initial=-1)) == len(rank) - 1:
            return rank
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-width] = rank[width:] + 1
        rank, width = rank * (len(rank) + 1) + ahead, 2 * width


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Positions by ascending suffix. text: numbers below alphabet, ending with the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    changes = np.flatnonzero(text[:-1] != text[1:])
    next_change = changes[np.searchsorted(changes, np.arange(n - 1))]
    small = np.ones(n, bool)  # whether the suffix is smaller than the next one
    small[:-1] = text[next_change] < text[next_change + 1]
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    first = _induce(text, small, lms, alphabet)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = first[is_lms[first]]
    # equal LMS substrings, now neighbours, get equal names
    end_of = np.full(n, n - 1, np.int64)
    end_of[lms[:-1]] = lms[1:]
    a, b = by_substring[:-1], by_substring[1:]
    length = end_of[a] - a
    equal = (length == end_of[b] - b) & (a != n - 1)
    alive, step = np.flatnonzero(equal), 0
    while len(alive):
        same = text[a[alive] + step] == text[b[alive] + step]
        equal[alive[~same]] = False
        alive, step = alive[same], step + 1
        alive = alive[length[alive] >= step]
    name = np.zeros(n, np.int64)
    name[by_substring] = np.concatenate([[0], np.cumsum(~equal)])
    names = name[lms]
    kinds = int(names.max()) + 1
    if kinds == len(names):
        in_order = by_substring
    elif kinds <= RECURSE_ALPHABET:
        in_order = lms[suffix_array(names, kinds)]
    else:
        rank = _ranked_by_doubling(names)
        in_order = np.empty(len(lms), np.int64)
        in_order[rank] = lms
    return _induce(text, small, in_order, alphabet)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, how long a prefix its suffix shares with the suffix before it in the suffix array.

    Where both are preceded by the same symbol, the length is that of the position before less one; only
    the other positions are compared, four symbols at a step.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    inherits = np.zeros(n, bool)
    ok = (before > 0) & (at > 0)
    inherits[ok] = text[at[ok] - 1] == text[before[ok] - 1]
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(4, np.uint64)])
    four = padded[:n] | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(32) | padded[3 : n + 3] << np.uint64(48)
    shared = np.zeros(n, np.int64)
    left = np.flatnonzero(~inherits & (before >= 0))
    i, j = left, before[left]
    while len(left):
        room = (i < n) & (j < n)
        left, i, j = left[room], i[room], j[room]
        gap = four[i] ^ four[j]
        same = gap == 0
        tail = gap[~same]
        shared[left[~same]] += (tail & np.uint64(0xFFFF) == 0).astype(np.int64) + (tail & np.uint64(0xFFFFFFFF) == 0) + (tail & np.uint64(0xFFFFFFFFFFFF) == 0)
        left, i, j = left[same], i[same] + 4, j[same] + 4
        shared[left] += 4
    source = np.maximum.accumulate(np.where(inherits, 0, at))
    return np.maximum(shared[source] - (at - source), 0)
