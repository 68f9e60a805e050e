"""Suffix arrays by induced sorting, in numpy, and common prefixes in text order.

Leftmost-smaller substrings are sorted by induction, named, and the string of names is sorted in the same way, or by
doubling once it has very many symbols. Induction goes bucket by bucket: all suffixes that a stretch of sorted ones induces are placed at once, by a
stable sort on their first symbols, so the steps number the symbols and the longest run rather than
the suffixes.
"""

from __future__ import annotations

import numpy as np

# A reduced string of more symbols than this is ranked by doubling: bucket steps would be as many.
WIDE = 1024
SHORT = 32
# Text positions compared at a time.
STRETCH = 1 << 18


def _places(n: int) -> type:
    """The type of positions in ``n`` symbols: 32 bits hold most, and halve the memory."""
    return np.int32 if n < (1 << 31) - 1 else np.int64


def _suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last, the sentinel, counts as such."""
    n = len(s)
    at = np.where(s[1:] != s[:-1], np.arange(n - 1, dtype=np.int32), np.int32(n - 1))
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = s[at] < s[at + 1]
    return out


def _placed(sa: np.ndarray, fill: np.ndarray, symbols: np.ndarray, at: np.ndarray, down: bool) -> None:
    """Put suffixes ``at`` into the buckets of their ``symbols`` in order, moving the fill marks."""
    order = np.argsort(symbols, kind="stable")
    symbols, at = symbols[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    del order
    counts = np.diff(np.append(first, len(symbols)))
    own = symbols[first]
    rank, kind = np.arange(len(symbols), dtype=sa.dtype), sa.dtype
    if down:
        sa[np.repeat((fill[own] - 1 + first).astype(kind), counts) - rank] = at
        fill[own] -= counts
    else:
        sa[np.repeat((fill[own] - first).astype(kind), counts) + rank] = at
        fill[own] += counts


def _induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from leftmost-smaller suffixes in the given order."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    used = np.flatnonzero(sizes).tolist()
    sa = np.full(len(s), -1, _places(len(s)))
    seeds = np.bincount(s[lms], minlength=len(sizes))
    _placed(sa, ends - seeds, s[lms], lms, down=False)
    heads = starts.copy()

    def push(at: np.ndarray, want: bool, fill: np.ndarray) -> None:
        before = at[at > 0] - 1
        before = before[small[before] == want]
        if len(before):
            _placed(sa, fill, s[before], before, down=want)

    for c in used:  # larger suffixes, from the left
        done = starts[c]
        while done < heads[c]:
            upto = heads[c]
            push(sa[done:upto], False, heads)
            done = upto
        if seeds[c]:
            push(sa[ends[c] - seeds[c]:ends[c]], False, heads)
    tails = ends.copy()
    for c in reversed(used):  # smaller suffixes, from the right; the seeds are placed anew
        done = ends[c]
        while done > tails[c]:
            upto = tails[c]
            push(sa[upto:done][::-1], True, tails)
            done = upto
        if heads[c] > starts[c]:
            push(sa[starts[c]:heads[c]][::-1], True, tails)
    sa[0] = len(s) - 1  # nothing comes before the sentinel to induce it
    return sa


def _names(s: np.ndarray, lms: np.ndarray, stop: int | None) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings in their sorted order; equal ones without ``stop`` share a rank."""
    sorted_at = np.sort(lms)
    length = np.zeros(len(s), np.int32)
    length[sorted_at[:-1]] = np.diff(sorted_at) + 1
    length[sorted_at[-1]] = 1
    a, b = lms[:-1], lms[1:]
    same = length[a] == length[b]
    if stop is not None:
        stops = np.zeros(len(s) + 1, np.int32)
        np.cumsum(s == stop, dtype=np.int32, out=stops[1:])
        same &= stops[b + length[b]] == stops[b]
        del stops
    open_ = np.flatnonzero(same).astype(lms.dtype)
    offset = 0
    while len(open_):
        equal = s[a[open_] + offset] == s[b[open_] + offset]
        same[open_[~equal]] = False
        open_ = open_[equal]
        offset += 1
        open_ = open_[length[a[open_]] > offset]
    names = np.zeros(len(lms), lms.dtype)
    np.cumsum(~same, dtype=lms.dtype, out=names[1:])
    return names


def _doubled(names: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The suffix array of a string of many different symbols, by doubling the length that ranks stand for.

    ``order`` has the places by name. A rank is the first place of its group of equal suffixes, so groups are sorted
    where they stand, and those of one suffix are not touched again.
    """
    n, length, kind = len(names), 1, _places(len(names))
    order = order.astype(kind)
    new = np.concatenate(([True], np.diff(names[order]) != 0))
    ranks = np.empty(n, kind)
    ranks[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=kind), 0))
    spots = np.flatnonzero(~(new & np.append(new[1:], True))).astype(kind)  # places in order of suffixes that have equals
    while len(spots):
        at = order[spots]
        key = ranks[at].astype(np.int64)
        key *= n + 1
        inside = np.flatnonzero(at < n - length)  # past the end is less than any rank
        key[inside] += ranks[at[inside] + kind(length)] + 1
        del inside
        sort = np.argsort(key)
        at, key = at[sort], key[sort]
        del sort
        order[spots] = at
        new = np.concatenate(([True], key[1:] != key[:-1]))
        del key
        ranks[at] = spots[np.maximum.accumulate(np.where(new, np.arange(len(at), dtype=kind), 0))]
        spots = spots[~(new & np.append(new[1:], True))]
        length *= 2
    return order


def suffix_array(s: np.ndarray, stop: int | None = None) -> np.ndarray:
    """Positions of all suffixes in order. ``s`` ends in a 0 that occurs nowhere else.

    With a symbol ``stop``, suffixes that agree up to and including it may come in any order. Substrings that hold it are
    then names of their own, so that joined strings end the recursion where they end.
    """
    # Symbols of 16 bits are sorted by radix.
    s = s.astype(np.uint16 if len(s) == 0 or s.max() < 1 << 16 else np.int64, copy=False)
    if len(s) <= SHORT:
        plain = s.tolist()
        return np.array(sorted(range(len(plain)), key=lambda i: plain[i:]), np.int64)
    small = _suffix_types(s)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(_places(len(s)))
    sizes = np.bincount(s)
    first = _induced(s, small, lms, sizes)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    del first, is_lms
    names = _names(s, ordered, stop)
    if names[-1] + 1 < len(ordered):
        number = np.zeros(len(s), np.int32)
        number[lms] = np.arange(len(lms), dtype=np.int32)
        by_name = number[ordered]
        reduced = np.empty(len(lms), np.int32)
        reduced[by_name] = names
        wide = names[-1] >= WIDE
        del number, names
        ordered = lms[_doubled(reduced, by_name) if wide else suffix_array(reduced)]
        del by_name, reduced
    return _induced(s, small, ordered, sizes)


def reaches(raw: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """Per text position, whether the suffix there is in ``sa`` and shares ``length`` bytes with the one before it in ``sa``.

    This is the permuted common-prefix array cut off at ``length``: it is worked out in text order, a stretch of it and eight
    bytes at a time, and only as long as the bytes agree. ``sa`` may leave out suffixes. ``raw`` has ``length`` spare bytes at its end.
    """
    before = np.full(len(raw), -1, _places(len(raw)))
    before[sa[1:]] = sa[:-1]
    words = np.ndarray((len(raw) - 7,), "<u8", np.ascontiguousarray(raw), 0, (1,))
    out = np.zeros(len(raw), bool)
    for first in range(0, len(raw), STRETCH):
        alive = np.flatnonzero(before[first:first + STRETCH] >= 0) + first
        for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
            alive = alive[words[alive + offset] == words[before[alive] + offset]]
        out[alive] = True
    return out
