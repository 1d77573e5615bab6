"""Suffix arrays by induced sorting, and permuted common prefixes (numpy).

Induction is a scan over the suffix array in which an entry may place its left neighbour further
on.  The scan runs in windows: a window ends before the first place that one of its own entries
fills, so all of a window's entries are final when they are read.  The recursion ends at texts of
at most ``DIRECT`` names, whose tiny buckets make windows short; those are sorted by doubling.
"""

from __future__ import annotations

import numpy as np

DIRECT = 1 << 17

def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is S-type (smaller than the next one); the last suffix is L-type."""
    n = len(t)
    up = np.zeros(n, dtype=bool)
    up[:-1] = t[:-1] < t[1:]
    same = np.zeros(n, dtype=bool)
    same[:-1] = t[:-1] == t[1:]
    # A run of equal symbols has the type of its last member.
    last = np.where(same, n, np.arange(n))
    ends = np.minimum.accumulate(last[::-1])[::-1]
    return up[ends]


def _number(keys: np.ndarray) -> np.ndarray:
    """Each element's number among the equal ones before it."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k))))
    return number


def _induce(t, small, sa, heads, s_type: bool) -> None:
    """Place the left neighbours of one type: L-type scanning up, S-type scanning down.

    Scanning down is scanning up on mirrored places; ``heads`` counts from the scan's own end.
    """
    n, step, pos = len(t), 1 << 12, 0
    line = sa[::-1] if s_type else sa
    while pos < n:
        end = min(n, pos + step)
        at = np.flatnonzero(line[pos:end] > 0)
        left = line[pos:end][at] - 1
        keep = small[left] == s_type
        at, left = at[keep] + pos, left[keep]
        done = end
        if len(at):
            key = t[left]
            place = heads[key] + _number(key)
            nearest = np.minimum.accumulate(place)
            clash = np.flatnonzero(nearest[:-1] <= at[1:])
            k = int(clash[0]) + 1 if len(clash) else len(at)
            done = min(end, int(nearest[k - 1]))
            line[place[:k]] = left[:k]
            heads[key[:k]] = place[:k] + 1        # of equal keys the last one stays
        step = min(1 << 16, max(64, 2 * (done - pos)))
        pos = done


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a short text: rank by the first name, then by twice as many each round."""
    n, span = len(names), 1
    rank = np.unique(names, return_inverse=True)[1]
    while rank.max() < n - 1:
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:n - span] = rank[span:] + 1 if span < n else 0
        rank = np.unique(rank * (n + 1) + nxt, return_inverse=True)[1]
        span *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``t`` (integers below ``symbols``); a shorter suffix sorts before its extensions."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(t, minlength=symbols)
    ends = np.cumsum(counts)
    starts = ends - counts

    def induced(order: np.ndarray) -> np.ndarray:
        sa = np.full(n, -1, dtype=np.int64)
        # Leftmost S-type suffixes at the ends of their buckets, in the given order.
        key = t[order[::-1]]
        sa[ends[key] - 1 - _number(key)] = order[::-1]
        heads = starts.copy()
        # The empty suffix comes first and places the last suffix, which is L-type.
        sa[heads[t[-1]]] = n - 1
        heads[t[-1]] += 1
        _induce(t, small, sa, heads, False)
        seen = sa >= 0
        own = np.zeros(n, dtype=bool)
        own[seen] = small[sa[seen]]
        sa[own] = -1                                    # S-type places are filled anew, from the right
        _induce(t, small, sa, n - ends, True)
        return sa

    if not len(lms):
        return induced(lms)
    sa = induced(lms)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    sorted_lms = sa[is_lms[sa]]
    # Name the substrings from one leftmost S-type place to the next.
    nth = np.full(n, -1, dtype=np.int64)
    nth[lms] = np.arange(len(lms))
    stop = np.append(lms[1:], n - 1)
    a, b = sorted_lms[:-1], sorted_lms[1:]
    la, lb = stop[nth[a]] - a, stop[nth[b]] - b
    equal = (la == lb) & (a + la < n) & (b + lb < n)
    live = np.flatnonzero(equal)
    off = 0
    while len(live):
        same = t[a[live] + off] == t[b[live] + off]
        equal[live[~same]] = False
        live = live[same]
        off += 1
        live = live[la[live] >= off]
    # The last substring runs into the end of the text and equals no other.
    tail = lms[-1]
    equal[(a == tail) | (b == tail)] = False
    names = np.zeros(len(lms), dtype=np.int64)
    names[nth[sorted_lms]] = np.concatenate([[0], np.cumsum(~equal)])
    kinds = int(names.max()) + 1
    if kinds == len(lms):
        order = np.empty(len(lms), dtype=np.int64)
        order[names] = lms
    else:
        order = lms[_doubled(names) if len(names) <= DIRECT else suffix_array(names, kinds)]
    return induced(order)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position of the bytes ``t``, its common prefix (at most ``limit``) with the suffix
    sorted just before it.

    Only irreducible positions, whose left neighbours differ, are compared, eight bytes at a time;
    at any other position the value is one less than at the position before.
    """
    n = len(t)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, dtype=bool)
    ok = before[1:] > 0
    left = np.where(ok, before[1:] - 1, 0)
    reducible[1:] = ok & (t[:-1] == t[left]) & (before[:-1] == left)
    begins = np.flatnonzero(~reducible)
    runs = np.diff(np.append(begins, n))
    first, want = begins[before[begins] >= 0], (limit + runs)[before[begins] >= 0]
    padded = np.concatenate([t, np.zeros(16, np.uint8)])
    eight = np.ndarray((n + 8,), dtype="<u8", buffer=padded, strides=(1,))
    lcp = np.zeros(len(first), dtype=np.int64)
    live = np.arange(len(first))
    while len(live):
        i, j = first[live] + lcp[live], before[first[live]] + lcp[live]
        differ = eight[i] ^ eight[j]
        low = differ & (~differ + np.uint64(1))
        step = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) >> 3)
        lcp[live] += np.minimum(step, n - np.maximum(i, j))
        live = live[(step == 8) & (np.maximum(i, j) + 8 < n) & (lcp[live] < want[live])]
    value = np.zeros(n, dtype=np.int64)
    value[first] = lcp
    start = np.repeat(begins, runs)
    return np.clip(value[start] - (np.arange(n) - start), 0, limit)
