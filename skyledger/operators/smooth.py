"""Robust locally weighted lines (Cleveland 1979) at the places of a curve, on arrays or on columns in files.

The curve is a straight line between its places, so only the values there are kept; weights of the robust rounds follow from the
curve of the round before. A wide window's sums are those of its blocks: the tricube weight is a polynomial on either side of a place, and
the sums of powers of a block's points, with their robust weights, serve all windows that hold it. What a window holds of a block only in part
is summed by points."""

from __future__ import annotations

import os
import tempfile
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from math import comb

import numpy as np

#: Points of a window beyond which it is summed by blocks, blocks of a window, and values held at once.
WIDE, BLOCKS, PART = 20_000, 256, 1 << 18
#: Values of a matrix of narrow windows, and of those that are kept from round to round.
MATRIX, KEPT = 1 << 15, 1 << 17
#: Coefficients of u^a (1 - u^3)^3 with u = c + t, by a, power of c and power of t.
TRICUBE = np.zeros((3, 12, 12))
for _a in range(3):
    for _e, _k in ((0, 1), (3, -3), (6, 3), (9, -1)):
        for _j in range(_e + _a + 1):
            TRICUBE[_a, _e + _a - _j, _j] = comb(_e + _a, _j) * _k


class Column:
    """Doubles in a file of the task's temporary folder, which goes with the object."""

    def __init__(self) -> None:
        self._file, self._n = tempfile.TemporaryFile(prefix="skyledger-", buffering=0), 0

    def append(self, values: np.ndarray) -> None:
        left = memoryview(np.ascontiguousarray(values, float)).cast("B")
        while left:
            left = left[self._file.write(left) :]
        self._n += len(values)

    def __len__(self) -> int:
        return self._n

    def __getitem__(self, at: int | slice | np.ndarray) -> np.ndarray | float:
        if isinstance(at, slice):
            first, stop, _ = at.indices(self._n)
            return np.frombuffer(os.pread(self._file.fileno(), 8 * (stop - first), 8 * first)) if stop > first else np.zeros(0)
        if isinstance(at, np.ndarray):
            return np.array([self[int(k)] for k in at])
        at = int(at) + (self._n if at < 0 else 0)
        if not 0 <= at < self._n:
            raise IndexError(at)
        return float(np.frombuffer(os.pread(self._file.fileno(), 8, 8 * at))[0])


Values = np.ndarray | Column


def parts(n: int, size: int | None = None) -> Iterator[slice]:
    size = size or PART
    return (slice(k, min(k + size, n)) for k in range(0, n, size))


def middle(values: Callable[[], Iterator[np.ndarray]], n: int) -> float:
    """The exact median of n doubles that aren't negative, made anew for each of two passes."""
    counts = np.zeros(1 << 17, np.int64)
    for v in values():
        counts += np.bincount((v + 0.0).view(np.int64) >> 46, minlength=len(counts))
    upto, ranks = np.cumsum(counts), [(n - 1) // 2, n // 2]
    bins = np.searchsorted(upto, ranks, "right")
    own = np.sort(np.concatenate([v[((kind := (v + 0.0).view(np.int64) >> 46) == bins[0]) | (kind == bins[1])] for v in values()]))
    before = upto[bins[0]] - counts[bins[0]]
    return float(own[np.array(ranks) - before].mean())


def _places(x: Values, k: int, delta: float) -> tuple[np.ndarray, np.ndarray]:
    """The points with a line of their own, and the first point of the window of each."""
    n, at = len(x), [0]
    seen = x.tolist() if isinstance(x, np.ndarray) and n < 10_000 else x
    while (last := bisect_right(seen, seen[at[-1]], at[-1]) - 1) < n - 1:
        # Points at the same x have its value; the next place is the last one within delta.
        at.append(max(last + 1, bisect_right(seen, seen[at[-1]] + delta, last) - 1))
    at = np.array(at)
    # The first window whose left end is no farther than what comes after its right end, by halving.
    mid, low, high = x[at], np.zeros(len(at), np.int64), np.full(len(at), n - k)
    while (still := low < high).any():
        m = np.minimum((low + high) // 2, n - k - 1)
        far = mid - x[m] > x[m + k] - mid
        low, high = np.where(still & far, m + 1, low), np.where(still & ~far, m, high)
    return at, low


def _weights(far: np.ndarray, reach: np.ndarray | float) -> np.ndarray:
    u = far / np.maximum(reach, 1e-300)
    cube = 1 - u * u * u
    return np.where(far <= 0.999 * reach, np.where(far > 0.001 * reach, cube * cube * cube, 1.0), 0.0)


class _Narrow:
    """Sums of windows by points."""

    def __init__(self, x: np.ndarray, y: np.ndarray, mid: np.ndarray, left: np.ndarray, k: int, reach: np.ndarray):
        self.x, self.y, self.mid, self.left, self.k, self.reach = x, y, mid, left, k, reach
        self.kept = list(self._made()) if len(mid) * k <= KEPT else None

    def _made(self) -> Iterator[tuple]:
        xs, ys = (np.lib.stride_tricks.sliding_window_view(v, self.k) for v in (self.x, self.y))
        for own in parts(len(self.mid), max(1, MATRIX // self.k)):
            off = xs[self.left[own]] - self.mid[own, None]
            yield own, _weights(np.abs(off), self.reach[own, None]), off, ys[self.left[own]]

    def __call__(self, weight: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> np.ndarray:
        out = np.empty((5, len(self.mid)))
        robust = None if weight is None else np.lib.stride_tricks.sliding_window_view(weight(self.x, self.y), self.k)
        for own, w, off, y in self.kept or self._made():
            if robust is not None:
                w = w * robust[self.left[own]]
            wo = w * off
            out[:, own] = w.sum(1), wo.sum(1), (wo * off).sum(1), (w * y).sum(1), (wo * y).sum(1)
        return out


class _Wide:
    """Sums of windows by blocks."""

    def __init__(self, x: Values, y: Values, mid: np.ndarray, left: np.ndarray, k: int, reach: np.ndarray):
        self.x, self.y, self.mid, self.reach, self.size = x, y, mid, reach, max(64, k // BLOCKS)
        size, blocks = self.size, len(x) // self.size
        first, last = (x[np.arange(blocks) * size + j] for j in (0, size - 1))
        self.centre, self.half = (first + last) / 2, np.where(last > first, (last - first) / 2, 1.0)
        self.pieces, of, block, side = [], [], [], []
        for i, (m, a, r) in enumerate(zip(mid.tolist(), left.tolist(), reach.tolist(), strict=True)):
            low, high = bisect_left(x, m - 0.999 * r, a, a + k), bisect_right(x, m + 0.999 * r, a, a + k)
            inner, outer = bisect_left(x, m - 0.001 * r, a, a + k), bisect_right(x, m + 0.001 * r, a, a + k)
            edges = [low]
            for start, stop, sign in ((low, inner, -1), (outer, high, 1)):
                b, e = -(-start // size), min(stop // size, blocks)
                if e > b:
                    edges += [b * size, e * size]
                    of.append(np.full(e - b, i))
                    block.append(np.arange(b, e))
                    side.append(np.full(e - b, sign))
            edges.append(high)
            for s, e in zip(edges[::2], edges[1::2], strict=True):
                self.pieces += [(i, s + p.start, s + p.stop) for p in parts(e - s)]
        self.of, self.block, self.side = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (of, block, side))
        c = self.side * (self.centre[self.block] - mid[self.of]) / reach[self.of]
        t = self.side * self.half[self.block] / reach[self.of]
        powers, scale = np.vander(c, 12, increasing=True), np.vander(t, 12, increasing=True)
        self.terms = [(powers @ TRICUBE[a]) * scale * (self.side**a * reach[self.of] ** a)[:, None] for a in range(3)]

    def __call__(self, weight: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> np.ndarray:
        plain, times_y = self._moments(weight)
        out = np.array([np.bincount(self.of, np.einsum("ij,ij->i", self.terms[a], m[self.block]), len(self.mid)) for a, m in ((0, plain), (1, plain), (2, plain), (0, times_y), (1, times_y))])
        for own in self._together():
            of, start, stop = np.array(own).T
            x, y = (np.concatenate([v[a:b] for _, a, b in own]) for v in (self.x, self.y))
            i = np.repeat(of, stop - start)
            off = x - self.mid[i]
            w = _weights(np.abs(off), self.reach[i])
            if weight is not None:
                w *= weight(x, y)
            first = np.append(0, np.cumsum(stop - start)[:-1])
            for row, value in enumerate((w, w * off, w * off * off, w * y, w * off * y)):
                out[row] += np.bincount(of, np.add.reduceat(value, first), len(self.mid))
        return out

    def _together(self) -> Iterator[list[tuple[int, int, int]]]:
        """Pieces of windows, as many at a time as stay in the cache."""
        own, n = [], 0
        for piece in self.pieces:
            own.append(piece)
            n += piece[2] - piece[1]
            if n > MATRIX:
                yield own
                own, n = [], 0
        if own:
            yield own

    def _moments(self, weight: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        plain, times_y = np.empty((len(self.centre), 12)), np.empty((len(self.centre), 12))
        # Few points at a time, which stay in the cache for all powers.
        for own in parts(len(self.centre), max(1, MATRIX // self.size)):
            at = slice(own.start * self.size, own.stop * self.size)
            x, y = self.x[at], self.y[at]
            power = (np.ones(len(x)) if weight is None else weight(x, y)).reshape(-1, self.size).copy()
            x, y = x.reshape(-1, self.size), y.reshape(-1, self.size)
            t = (x - self.centre[own, None]) / self.half[own, None]
            for p in range(12):
                plain[own, p] = power.sum(1)
                times_y[own, p] = np.einsum("ij,ij->i", power, y)
                power *= t
        return plain, times_y


def bisquare(rest: np.ndarray, scale: float) -> np.ndarray:
    return np.where(rest <= 0.001 * scale, 1.0, np.where(rest <= 0.999 * scale, (1 - np.minimum(rest / scale, 1) ** 2) ** 2, 0.0))


def curve_places(x: Values, y: Values, share: float = 2 / 3, rounds: int = 3, delta: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the curve, which is straight between them; x ascending."""
    n = len(x)
    k = min(n, max(2, int(share * n + 1e-10)))
    at, left = _places(x, k, delta)
    mid, own = x[at], y[at]
    reach = np.maximum(mid - x[left], x[left + k - 1] - mid)
    wide = k > WIDE and not (reach <= 0).any()
    if not wide:
        x, y = x[:], y[:]
    sums, weight = (_Wide if wide else _Narrow)(x, y, mid, left, k, reach), None
    least = (0.001 * (x[-1] - x[0])) ** 2
    for step in range(rounds + 1):
        s0, s1, s2, t0, t1 = sums(weight)
        known = s0 > 0
        s0 = np.where(known, s0, 1.0)
        mean, value = s1 / s0, t0 / s0
        spread = s2 / s0 - mean * mean
        slope = np.where(spread > least, (t1 / s0 - mean * value) / np.where(spread > least, spread, 1.0), 0.0)
        fitted = np.where(known, value - mean * slope, own)
        if step < rounds:
            far = lambda a, b, fitted=fitted: np.abs(b - np.interp(a, mid, fitted))
            scale = 6 * (middle(lambda: (far(x[p], y[p]) for p in parts(n)), n) if wide else float(np.median(far(x, y))))
            if scale <= 0:
                break
            weight = lambda a, b, far=far, scale=scale: bisquare(far(a, b), scale)
    return mid, fitted
