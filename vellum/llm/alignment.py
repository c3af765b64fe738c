"""Alignment of two word sequences within a band: the greedy difference algorithm on whole arrays.

Furthest points are kept per number of differences (insertions and deletions) and diagonal; all diagonals of one number
of differences advance together. Only diagonals from which the end can still be reached within the band are kept, so
time grows with length plus the square of the differences. Paths of few differences are traced over kept points; beyond
KEPT differences the path is cut in the middle and each half is aligned by itself, so memory stays linear in the band.
"""

from __future__ import annotations

import numpy as np

from . import tokens

#: Differences up to which all furthest points are kept (a triangle of 32-bit numbers: 64 MB at most).
KEPT = 4000
#: Differences up to which a path is first sought one diagonal at a time, which is quicker for so few.
FEW = 256
_NONE = -(1 << 30)


class _Pair:
    """Two sequences, and how far they agree from given places."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b, self.n, self.m = a, b, len(a), len(b)
        self.sums = None

    def _prefix(self) -> None:
        up, self.down = tokens.powers(max(self.n, self.m) + 1)
        self.sums = []
        for v in (self.a, self.b):
            s = np.zeros(len(v) + 1, np.uint64)
            np.cumsum(tokens.mix(v) * up[: len(v)], out=s[1:])
            self.sums.append(s)

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """x after sliding along equal words from each (x, y): one word at a time, then by doubling on prefix hashes."""
        x = x.copy()
        live = np.flatnonzero((x >= 0) & (x < self.n) & (y >= 0) & (y < self.m))
        at = x[live]
        shift = y[live] - at
        for _ in range(6):
            same = self.a[at] == self.b[at + shift]
            live, at, shift = live[same], at[same] + 1, shift[same]
            x[live] = at
            room = (at < self.n) & (at + shift < self.m)
            if not room.all():
                live, at, shift = live[room], at[room], shift[room]
            if not len(live):
                return x
        if self.sums is None:
            self._prefix()
        sa, sb = self.sums
        room = np.minimum(self.n - at, self.m - at - shift)
        done = np.zeros(len(at), np.int64)
        step = 8

        def equal(to):
            u, v = at + done, at + shift + done
            return (sa[u + to] - sa[u]) * self.down[u] == (sb[v + to] - sb[v]) * self.down[v]

        growing = np.ones(len(at), bool)
        width = np.zeros(len(at), np.int64)
        while growing.any():
            fits = growing & (done + step <= room)
            ok = np.zeros(len(at), bool)
            ok[fits] = equal(np.where(fits, step, 0))[fits]
            done[ok] += step
            width[growing & ~ok] = step
            growing = ok
            step *= 2
        step = int(width.max())
        while step:
            fits = (done + step <= room) & (width >= step)
            if fits.any():
                ok = fits & equal(np.where(fits, step, 0))
                done[ok] += step
            step //= 2
        x[live] = at + done
        return x


def _forward(p: _Pair, most: int, keep: bool, half: int = -1):
    """(differences, kept points, (x, k) where the path to the end stood after `half` differences); None beyond `most`."""
    n, m = p.n, p.m
    end, lo = n - m, 0
    x = np.zeros(1, np.int64)
    origin = crossing = None
    kept = []
    for d in range(most + 1):
        if d:
            left, right = np.append(_NONE, x + 1), np.append(x, _NONE)
            if origin is not None:
                origin = np.where(left > right, np.append(0, origin), np.append(origin, 0))
            x, lo = np.maximum(left, right), lo - 1
            # diagonals outside of both texts, or too far from the end for the differences left
            low, high = max(-m, end - (most - d)), min(n, end + (most - d))
            skip = max(0, -(-(low - lo) // 2))
            stop = len(x) - max(0, -(-(lo + 2 * (len(x) - 1) - high) // 2))
            if skip or stop < len(x):
                x, lo = x[skip:stop], lo + 2 * skip
                origin = origin[skip:stop] if origin is not None else None
            if not len(x):
                return None
        k = lo + 2 * np.arange(len(x))
        bad = (x > n) | (x - k > m)
        x = p.agree(np.where(bad, _NONE, x), np.where(bad, _NONE, x - k))
        if keep:
            kept.append((lo, x.astype(np.int32)))
        if d == half:
            origin, crossing = np.arange(len(x)), (x, lo)
        if (end - lo) % 2 == 0 and 0 <= (i := (end - lo) // 2) < len(x) and x[i] >= n:
            at = None
            if origin is not None:
                j = int(origin[i])
                at = int(crossing[0][j]), crossing[1] + 2 * j
            return d, kept, at
    return None


def _trace(p: _Pair, kept: list, d: int) -> list[tuple[int, int, int]]:
    """Runs (x, y, length) from kept points, first to last."""
    runs, k, x = [], p.n - p.m, p.n
    for e in range(d, 0, -1):
        lo, before = kept[e - 1]
        i = (k - 1 - lo) // 2
        left = int(before[i]) + 1 if 0 <= i < len(before) else _NONE
        right = int(before[i + 1]) if 0 <= i + 1 < len(before) else _NONE
        start = max(left, right)
        runs.append((start, start - k, x - start))
        x, k = (left - 1, k - 1) if left > right else (right, k + 1)
    runs.append((0, 0, x))
    return [r for r in runs[::-1] if r[2] > 0]


def _near(a: np.ndarray, b: np.ndarray, most: int) -> list[tuple[int, int, int]] | None:
    """The same runs, one diagonal at a time, on lists that end in values that nothing equals."""
    n, m = len(a), len(b)
    u, v = [*a.tolist(), -1], [*b.tolist(), -2]

    def slide(x: int, y: int) -> int:
        stop = x + 16
        while u[x] == v[y]:
            x, y = x + 1, y + 1
            if x == stop:
                break
        else:
            return x
        step = 64
        while x < n and y < m:
            k = min(step, n - x, m - y)
            differ = a[x : x + k] != b[y : y + k]
            at = int(differ.argmax())
            if at or differ[0]:
                return x + at
            x, y, step = x + k, y + k, step * 4
        return x

    # kept: the first diagonal, and the furthest points of every other one from there on between two of no point
    end, kept = n - m, []
    for d in range(most + 1):
        low, high = max(-d, -m, end - most + d), min(d, n, end + most - d)
        low += (low + d) % 2
        now = [_NONE]
        if d:
            lo, before = kept[-1]
            at = (low - 1 - lo) // 2 + 1
            for k in range(low, high + 1, 2):
                left, x = before[at] + 1, before[at + 1]
                at += 1
                if left > x:
                    x = left
                if 0 <= x <= n and 0 <= (y := x - k) <= m:
                    now.append(slide(x, y) if u[x] == v[y] else x)
                else:
                    now.append(_NONE)
        elif low <= high:
            now.append(slide(0, 0))
        now.append(_NONE)
        kept.append((low, now))
        if (end - low) % 2 == 0 and 0 < (i := (end - low) // 2 + 1) < len(now) and now[i] >= n:
            break
    else:
        return None
    runs, k, x = [], end, n
    for d in range(len(kept) - 1, 0, -1):
        lo, before = kept[d - 1]
        i = (k - 1 - lo) // 2 + 1
        left, right = before[i] + 1, before[i + 1]
        start = max(left, right)
        runs.append((start, start - k, x - start))
        x, k = (left - 1, k - 1) if left > right else (right, k + 1)
    runs.append((0, 0, x))
    return [r for r in runs[::-1] if r[2] > 0]


def _path(p: _Pair, most: int) -> list[tuple[int, int, int]] | None:
    if (found := _near(p.a, p.b, min(most, FEW))) is not None or most <= FEW:
        return found
    if most <= KEPT:
        found = _forward(p, most, keep=True)
        return None if found is None else _trace(p, found[1], found[0])
    found = _forward(p, most, keep=False)
    if found is None:
        return None
    d = found[0]
    if d <= KEPT:
        return _path(p, d)
    x, k = _forward(p, d, keep=False, half=d // 2)[2]
    y = x - k
    first = _path(_Pair(p.a[:x], p.b[:y]), d // 2)
    return first + [(u + x, v + y, n) for u, v, n in _path(_Pair(p.a[x:], p.b[y:]), d - d // 2)]


def matched_runs(a: np.ndarray, b: np.ndarray, most: int) -> list[tuple[int, int, int]] | None:
    """Runs (x, y, length) of equal words in the best alignment of a and b, or None beyond `most` insertions and deletions."""
    k = min(len(a), len(b))
    differ = np.flatnonzero(a[:k] != b[:k])
    head = int(differ[0]) if len(differ) else k
    k -= head
    differ = np.flatnonzero(a[len(a) - k :][::-1] != b[len(b) - k :][::-1])
    tail = int(differ[0]) if len(differ) else k
    u, v = a[head : len(a) - tail], b[head : len(b) - tail]
    if abs(len(u) - len(v)) > most:
        return None
    if not len(u) or not len(v):
        middle = []
    elif (middle := _path(_Pair(u, v), most)) is None:
        return None
    runs = ([(0, 0, head)] if head else []) + [(x + head, y + head, n) for x, y, n in middle]
    if tail:
        runs.append((len(a) - tail, len(b) - tail, tail))
    out: list[tuple[int, int, int]] = []
    for x, y, n in runs:  # runs that follow on one diagonal without a gap are one
        if out and out[-1][0] + out[-1][2] == x and out[-1][1] + out[-1][2] == y:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + n)
        else:
            out.append((x, y, n))
    return out
