"""Banded alignment: edit distances of many pairs of sequences at once, by furthest-reaching points on the diagonals of a band."""

from __future__ import annotations

import numpy as np

#: Longer sequences (in items) are aligned one pair at a time, with memory that doesn't grow with their length.
LONG = 200_000


def _common_prefix(x: np.ndarray, y: np.ndarray) -> int:
    """How many items x and y begin with alike; compared in blocks that double."""
    at, step, n = 0, 64, min(len(x), len(y))
    while at < n:
        other = np.flatnonzero(x[at : at + step][: n - at] != y[at : at + step][: n - at])
        if len(other):
            return at + int(other[0])
        at, step = at + step, 2 * step
    return n


def _one_distance(x: np.ndarray, y: np.ndarray, most: int) -> int:
    n, m = len(x), len(y)
    far: dict[int, int] = {}
    for e in range(most + 1):
        now = {}
        for k in range(-e, e + 1):
            i = max(far.get(k, -2) + 1, far.get(k + 1, -2) + 1, far.get(k - 1, -1)) if e else 0
            i = min(i, n, m - k)
            if i < 0 or i + k < 0:
                continue
            now[k] = i + _common_prefix(x[i:], y[i + k :])
        far = now
        if far.get(m - n) == n:
            return e
    return most + 1


def banded_distances(x: np.ndarray, fx: np.ndarray, y: np.ndarray, fy: np.ndarray, most: int) -> np.ndarray:
    """The edit distance of each pair of sequences, x[fx[p]:fx[p + 1]] and y[fy[p]:fy[p + 1]]; larger ones than `most` count as most + 1.

    Insertions, deletions and replacements cost 1 each. Only the 2 * most + 1 diagonals around the first are looked at, which hold every
    alignment of so few edits.
    """
    n, m = np.diff(fx), np.diff(fy)
    count, width = len(n), 2 * most + 1
    out = np.full(count, most + 1, np.int64)
    if not count:
        return out
    begin = fx[:-1] + np.arange(count)  # each sequence is followed by a place that never matches
    total = int(fx[-1]) + count
    own = np.repeat(np.arange(count), n + 1)
    at = np.arange(total) - begin[own]
    inside = at < n[own]
    place = np.arange(total)
    xs = np.zeros(total, x.dtype)
    xs[inside] = x
    base = fy[:-1][own] + at
    until = np.empty((width, total), np.int32)  # of each place, where the run of matches along a diagonal ends
    for d in range(width):
        j = at + d - most
        ok = inside & (j >= 0) & (j < m[own])
        same = ok & (xs == y[np.clip(base + d - most, 0, max(len(y) - 1, 0))]) if len(y) else np.zeros(total, bool)
        until[d] = np.minimum.accumulate(np.where(same, total, place)[::-1])[::-1]
    diagonal = np.arange(width) - most
    bound = np.minimum(n[:, None], m[:, None] - diagonal)
    far = np.full((count, width), -(1 << 30))
    rows, goal = np.arange(count), m - n + most
    reachable = np.abs(m - n) <= most
    for e in range(most + 1):
        if e:
            left = np.pad(far, ((0, 0), (1, 1)), constant_values=-(1 << 30))
            now = np.maximum(np.maximum(left[:, 1:-1] + 1, left[:, 2:] + 1), left[:, :-2])
        else:
            now = far.copy()
            now[:, most] = 0
        now = np.minimum(now, bound)
        ok = (now >= 0) & (now + diagonal >= 0)
        r, d = np.nonzero(ok)
        far = np.full((count, width), -(1 << 30))
        far[r, d] = until[d, begin[r] + now[r, d]] - begin[r]
        done = reachable & (out > most) & (far[rows, np.clip(goal, 0, width - 1)] == n)
        out[done] = e
        if (out <= most).sum() == reachable.sum():
            break
    return out


def aligned(x: np.ndarray, fx: np.ndarray, y: np.ndarray, fy: np.ndarray, most: int, items: int = 100_000) -> np.ndarray:
    """banded_distances() in pieces of so many items; very long pairs go one by one."""
    n = np.diff(fx)
    out = np.full(len(n), most + 1, np.int64)
    a = 0
    while a < len(n):
        if n[a] > LONG:
            out[a] = _one_distance(x[fx[a] : fx[a + 1]], y[fy[a] : fy[a + 1]], most)
            a += 1
            continue
        b = max(a + 1, int(np.searchsorted(fx, fx[a] + items, "right")) - 1)
        long = np.flatnonzero(n[a:b] > LONG)
        b = a + int(long[0]) if len(long) else b
        out[a:b] = banded_distances(x[fx[a] : fx[b]], fx[a : b + 1] - fx[a], y[fy[a] : fy[b]], fy[a : b + 1] - fy[a], most)
        a = b
    return out
