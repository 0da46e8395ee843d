"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

``suffix_array`` classifies suffixes, sorts the leftmost-smaller (LMS) substrings, recurses on their names while
two are equal, and induces all suffixes from the sorted LMS suffixes (Nong, Zhang and Chan 2009). A bucket is induced as a
whole: what it induces into later buckets is one stable scatter, and only suffixes that it induces into itself (runs of a
character) need further waves. The names of the recursion have too many buckets for that; they are scanned one by
one, over a third of the characters at most.
"""

from __future__ import annotations

import numpy as np

WIDE = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True for S-type suffixes: smaller than the next one. The last character is the unique smallest."""
    n = len(s) - 1
    at = np.where(s[1:] != s[:-1], np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(s[1:] > s[:-1], True)[following], True)


def _scatter(s, heads, sa, found, sign):
    """Put suffixes, in order, at the heads (or, from the right, the tails) of their buckets."""
    chars = s[found]
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    first = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
    size = np.diff(np.append(first, len(chars)))
    rank = np.arange(len(chars)) - np.repeat(first, size)
    sa[heads[chars] + sign * rank] = found[order]
    heads[chars[first]] += sign * size


def _induce(s, is_s, lms, ends) -> np.ndarray:
    """All suffixes in order, given LMS suffixes ``lms`` in order (or their substrings, given any order)."""
    starts = np.append(0, ends[:-1])
    sa = np.full(len(s), -1, np.int32)
    heads = starts.copy()
    # LMS suffixes stand apart for the left-to-right pass; they are at the ends of their buckets.
    by_char = lms[np.argsort(s[lms], kind="stable")]
    bounds = np.searchsorted(s[by_char], np.arange(len(ends) + 1))
    for c in range(len(ends)):
        low = starts[c]
        while low < heads[c]:
            high = heads[c]
            found = sa[low:high] - 1
            found = found[found >= 0]
            found = found[~is_s[found]]
            if len(found):
                _scatter(s, heads, sa, found, 1)
            low = high
        found = by_char[bounds[c] : bounds[c + 1]] - 1
        found = found[found >= 0]
        if len(found):
            _scatter(s, heads, sa, found, 1)
    tails = ends - 1
    for c in range(len(ends) - 1, -1, -1):
        high = ends[c] - 1
        while high > tails[c]:
            low = tails[c]
            found = sa[low + 1 : high + 1][::-1] - 1
            found = found[found >= 0]
            found = found[is_s[found]]
            if len(found):
                _scatter(s, tails, sa, found, -1)
            high = low
        found = sa[starts[c] : heads[c]][::-1] - 1
        found = found[found >= 0]
        found = found[is_s[found]]
        if len(found):
            _scatter(s, tails, sa, found, -1)
    sa[0] = len(s) - 1
    return sa


def _induce_names(s, is_s, lms, ends) -> np.ndarray:
    """The same for many buckets, suffix by suffix."""
    text, small, stop = s.tolist(), is_s.tolist(), ends.tolist()
    start = [0, *stop[:-1]]
    sa = [-1] * len(text)
    tail = [e - 1 for e in stop]
    for i in reversed(lms.tolist()):
        sa[tail[text[i]]] = i
        tail[text[i]] -= 1
    head = start[:]
    for i in sa:
        if i > 0 and not small[i - 1]:
            c = text[i - 1]
            sa[head[c]] = i - 1
            head[c] += 1
    tail = [e - 1 for e in stop]
    for at in range(len(sa) - 1, -1, -1):
        i = sa[at]
        if i > 0 and small[i - 1]:
            c = text[i - 1]
            sa[tail[c]] = i - 1
            tail[c] -= 1
    sa[0] = len(text) - 1
    return np.array(sa, np.int32)


def _names(s, is_s, lms, order) -> tuple[np.ndarray, int]:
    """Names of LMS substrings in text order, equal for equal substrings; how many there are."""
    length = np.diff(np.append(lms, len(s))) + 1
    index = np.empty(len(s), np.int32)
    index[lms] = np.arange(len(lms))
    a, b = order[:-1], order[1:]
    la, lb = length[index[a]], length[index[b]]
    # The sentinel's substring differs from all; equal lengths are compared character by character.
    differ = (la != lb) | (b == len(s) - 1) | (a == len(s) - 1)
    active = np.flatnonzero(~differ)
    k = 0
    while len(active):
        active = active[k < la[active]]
        x, y = a[active] + k, b[active] + k
        same = (s[x] == s[y]) & (is_s[x] == is_s[y])
        differ[active[~same]] = True
        active = active[same]
        k += 1
    rank = np.append(0, np.cumsum(differ))
    names = np.empty(len(lms), np.int32)
    names[index[order]] = rank
    return names, int(rank[-1]) + 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, in 32 bits; the last character must be 0 and occur once."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    ends = np.cumsum(np.bincount(s))
    induce = _induce if len(ends) <= WIDE else _induce_names
    is_s = _types(s)
    mark = is_s.copy()
    mark[0] = False
    mark[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(mark).astype(np.int32)
    if len(lms) == 1:
        return induce(s, is_s, lms, ends)
    order = induce(s, is_s, lms, ends)
    order = order[mark[order]]
    names, n = _names(s, is_s, lms, order)
    if n < len(lms):
        order = lms[suffix_array(names)]
    return induce(s, is_s, order, ends)


def common_prefixes(s: np.ndarray, sa: np.ndarray, cap: int, stride: int = 32) -> np.ndarray:
    """At each text position, the common prefix (up to ``cap``) with the suffix before it in the array.

    Computed in text order, where it falls by one at most from a position to the next: every ``stride``-th position
    is compared from the start, the others go on from their left neighbour.
    """
    before = np.empty(len(s), np.int32)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    out = np.zeros(len(s), np.int32)
    for phase in range(stride):
        at = np.arange(phase, len(s), stride)
        length = np.maximum(out[at - 1] - 1, 0) if phase else np.zeros(len(at), np.int32)
        active = np.flatnonzero((before[at] >= 0) & (length < cap))
        while len(active):
            here = at[active]
            same = s[here + length[active]] == s[before[here] + length[active]]
            active = active[same]
            length[active] += 1
            active = active[length[active] < cap]
        out[at] = length
    return out
