"""Suffix array of one shard by induced sorting, and its permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their successor.  The
substrings between leftmost S suffixes are sorted by inducing, named, and the
string of names is sorted by the same steps until names are unique; the order of
the leftmost S suffixes then induces the whole array in two linear passes.

A pass goes over the buckets of the first symbol.  What lies in a bucket is
complete when the pass reaches it, but for runs of its own symbol, so a bucket
(or several in a row that push nothing into each other) is one vector step.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last symbol is the
    unique smallest one."""
    ends = np.flatnonzero(np.append(t[1:] != t[:-1], True))
    rises = np.append(t[ends[1:]] > t[ends[:-1]], True)
    return np.repeat(rises, np.diff(ends, prepend=-1))


def _steps(reach: np.ndarray) -> list[tuple[int, int, bool]]:
    """Ranges of buckets for one vector step each (first, end, runs of its own
    symbol): nothing in a range is pushed into a later bucket of the same range."""
    out, c, n = [], 0, len(reach)
    near = reach.tolist()
    while c < n:
        if near[c] == c:
            out.append((c, c + 1, True))
            c += 1
            continue
        end, limit = c + 1, near[c]
        while end < n and end < limit and near[end] != end:
            limit = min(limit, near[end])
            end += 1
        out.append((c, end, False))
        c = end
    return out


def _push(sa: np.ndarray, t: np.ndarray, head: np.ndarray, who: np.ndarray, step: int) -> None:
    """Place the suffixes ``who``, in order, at the ends of their buckets."""
    symbol, n = t[who], len(who)
    if n == 1:
        at = symbol[0]
        sa[head[at]] = who[0]
        head[at] += step
        return
    order = symbol.argsort(kind="stable")
    symbol = symbol[order]
    cuts = np.flatnonzero(symbol[1:] != symbol[:-1])
    first = np.zeros(len(cuts) + 1, np.int64)
    first[1:] = cuts + 1
    sizes = np.empty_like(first)
    sizes[:-1] = first[1:]
    sizes[-1] = n
    sizes -= first
    used = symbol[first]
    at = head[used]
    head[used] += step * sizes
    if len(first) == 1:
        place = np.arange(at[0], at[0] + step * n, step)
    else:
        place = np.repeat(at - step * first, sizes) + np.arange(0, step * n, step)
    sa[place] = who[order]


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, starts: np.ndarray, steps: tuple) -> np.ndarray:
    """The suffix array induced from leftmost S suffixes ``lms``, which are taken
    in the given order within their buckets."""
    n, ends = len(t), np.append(starts[1:], len(t))
    sa = np.full(n, -1, np.int32)
    symbols = t[lms]
    counts = np.bincount(symbols, minlength=len(starts))
    tails = ends - counts
    _push(sa, t, tails, lms, 1)
    head = starts.copy()
    up, down = steps
    for a, b, runs in up:                       # L suffixes, ascending
        if runs:
            done = starts[a]
            while done < head[a]:
                who = sa[done:head[a]] - 1
                done = head[a]
                who = who[who >= 0]
                who = who[~small[who]]
                if len(who):
                    _push(sa, t, head, who, 1)
            who = sa[done:ends[a]]
        else:
            who = sa[starts[a]:ends[b - 1]]
        who = who[who > 0] - 1
        who = who[~small[who]]
        if len(who):
            _push(sa, t, head, who, 1)
    # S suffixes, descending; the leftmost ones are placed anew among them
    tail = ends - 1
    for a, b, runs in down:
        if runs:
            done = ends[a] - 1
            while done > tail[a]:
                who = sa[tail[a] + 1:done + 1][::-1] - 1
                done = tail[a]
                who = who[who >= 0]
                who = who[small[who]]
                if len(who):
                    _push(sa, t, tail, who, -1)
            who = sa[starts[a]:head[a]][::-1]
            who = who[who > 0] - 1
        else:
            who = _joined(sa, starts, head, tail, ends, a, b)
            who = who[who > 0] - 1
        who = who[small[who]]
        if len(who):
            _push(sa, t, tail, who, -1)
    sa[0] = n - 1
    return sa


def _joined(sa, starts, head, tail, ends, a: int, b: int) -> np.ndarray:
    """What buckets a to b - 1 hold so far, from the right: L parts up to their
    head, S parts from behind their tail."""
    lo, hi = int(starts[a]), int(ends[b - 1])
    if b == a + 1:
        return np.concatenate([sa[tail[a] + 1:hi][::-1], sa[lo:head[a]][::-1]])
    here = sa[lo:hi]
    # the gap between head and tail of a bucket holds stale leftmost S suffixes
    gap = np.zeros(hi - lo + 1, np.int32)
    np.add.at(gap, head[a:b] - lo, 1)
    np.add.at(gap, tail[a:b] + 1 - lo, -1)
    return here[np.cumsum(gap[:-1]) == 0][::-1]


def _names(t: np.ndarray, order: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """For leftmost S suffixes in sorted ``order``: whether the substring of each
    differs from the one before."""
    length = np.zeros(len(t), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    size = length[order]
    new = np.append(True, size[1:] != size[:-1])
    open_ = np.flatnonzero(~new)
    for k in range(64):
        open_ = open_[size[open_] > k]
        if not len(open_):
            break
        differs = t[order[open_] + k] != t[order[open_ - 1] + k]
        new[open_[differs]] = True
        open_ = open_[~differs]
    for i in open_[size[open_] > 64].tolist():
        x, y, m = order[i], order[i - 1], size[i]
        new[i] = not np.array_equal(t[x:x + m], t[y:y + m])
    return new


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array (int32) of symbols ``t`` whose last one is 0 and the only 0;
    every symbol up to the highest should occur, or buckets stay empty."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    counts = np.bincount(t)
    sigma = len(counts)
    starts = np.cumsum(counts) - counts
    # the nearest bucket that each bucket pushes into, in either pass
    larger = np.full(sigma, sigma, np.int64)
    where = np.flatnonzero(~small[:-1])
    np.minimum.at(larger, t[where + 1], t[where])
    smaller = np.full(sigma, -1, np.int64)
    where = np.flatnonzero(small[:-1])
    np.maximum.at(smaller, t[where + 1], t[where])
    down = [(sigma - b, sigma - a, runs) for a, b, runs in _steps((sigma - 1 - smaller)[::-1])]
    steps = (_steps(larger), down)
    marked = np.zeros(n, bool)
    marked[lms] = True
    sa = _induce(t, small, lms, starts, steps)
    order = sa[marked[sa]]
    new = _names(t, order, lms)
    if not new.all():
        name = np.zeros(n, np.int32)
        name[order] = np.cumsum(new) - 1
        order = lms[suffix_array(name[lms])]
    return _induce(t, small, order, starts, steps)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(neighbour, length): for every place the start of the suffix before it in
    sorted order (-1: none) and the length of their common prefix.

    In text order a length is at least the one before less 1, and equal to that
    where the two symbols before are the same; only the other places are compared,
    four symbols at a time."""
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    length = np.zeros(n, np.int64)
    has = np.flatnonzero(before >= 0)
    prev = before[has]
    inherits = (has > 0) & (prev > 0)
    inherits[inherits] = t[has[inherits] - 1] == t[prev[inherits] - 1]
    # the place before must itself have this neighbour's predecessor as its own
    inherits[inherits] = before[has[inherits] - 1] == prev[inherits] - 1
    x = has[~inherits]
    y = before[x].astype(np.int64)
    padded = np.concatenate([t.astype("<u2"), np.arange(4, dtype="<u2")])
    words = np.ndarray(n, "<u8", padded, strides=(2,))
    got = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    while len(live):
        i, j = x[live] + got[live], y[live] + got[live]
        differ = words[i] ^ words[j]
        same = differ == 0
        if not same.all():
            d = differ[~same]
            extra = ((d & np.uint64(0xFFFF)) == 0).astype(np.int64)
            extra += (d & np.uint64(0xFFFFFFFF)) == 0
            extra += (d & np.uint64(0xFFFFFFFFFFFF)) == 0
            got[live[~same]] += extra
            live = live[same]
        got[live] += 4
    length[x] = got
    # the last compared place at or before each inheriting one
    at = np.zeros(n, np.int64)
    at[x] = x
    at = np.maximum.accumulate(at)
    places = has[inherits]
    length[places] = length[at[places]] - (places - at[places])
    return before, length
