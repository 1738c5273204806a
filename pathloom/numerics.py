"""Numerical kernels in numpy for grouped functions: smoothing, peaks, clusters, lines, Kalman smoothing."""

from __future__ import annotations

from functools import lru_cache
from math import factorial

import numpy as np


def savgol(y: np.ndarray, window: int, order: int) -> np.ndarray:
    """Savitzky-Golay smoothing: a least-squares polynomial over a centred window; at the ends the polynomial of the outermost
    window. Even windows grow by one; shorter series and windows give the series back."""
    y = np.asarray(y, float)
    window += 1 - window % 2
    window = min(window, len(y) - (1 - len(y) % 2))
    if window <= order or window < 3:
        return y.copy()
    half = window // 2
    basis, fit = _polynomials(window, order)
    out = np.convolve(y, fit[0][::-1], "same")
    out[:half] = (basis @ (fit @ y[:window]))[:half]
    out[-half:] = (basis @ (fit @ y[-window:]))[-half:]
    return out


@lru_cache(maxsize=256)
def _polynomials(window: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers at a window's places, and what fits them to values."""
    half = window // 2
    basis = np.vander(np.arange(-half, half + 1) / half, order + 1, increasing=True)
    return basis, np.linalg.pinv(basis)


def peaks(y: np.ndarray, prominence: float) -> np.ndarray:
    """Positions of local maxima (the middle of flat ones) that stand out by `prominence` or more from the higher of the lowest points
    on either side before a higher value."""
    y = np.asarray(y, float)
    out, i, n = [], 1, len(y)
    while i < n - 1:
        if y[i] > y[i - 1]:
            j = i
            while j + 1 < n and y[j + 1] == y[i]:
                j += 1
            if j + 1 < n and y[j + 1] < y[i]:
                higher = np.flatnonzero(y[:i] > y[i])
                left = y[higher[-1] if len(higher) else 0 : i].min()
                higher = np.flatnonzero(y[j + 1 :] > y[i])
                right = y[j + 1 : j + 1 + (higher[0] + 1 if len(higher) else n)].min()
                if y[i] - max(left, right) >= prominence:
                    out.append((i + j) // 2)
            i = j
        i += 1
    return np.array(out, int)


class _Cells:
    """Points in the plane by cells so small that two of one cell are within `eps`; near cells are those within reach of it."""

    NEAR = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i * j) < 4]

    def __init__(self, points: np.ndarray, eps: float):
        self.points, self.limit = points, eps * eps
        # a shade less than eps / sqrt(2), for the corners of a cell must not be farther apart in floating point either
        keys = np.floor(points / (eps / 1.4142136)).astype(np.int64)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        cuts = np.flatnonzero((keys[order][1:] != keys[order][:-1]).any(1)) + 1
        self.cells = {tuple(keys[g[0]].tolist()): np.sort(g) for g in np.split(order, cuts)}

    def near(self, cell: tuple[int, int]):
        return ((c, self.cells[c]) for i, j in self.NEAR if (c := (cell[0] + i, cell[1] + j)) in self.cells)

    def distances(self, a: np.ndarray, b: np.ndarray):
        """Squared distances of the points a to the points b, some rows at a time."""
        step = max(1, 1_000_000 // max(1, len(b)))
        for k in range(0, len(a), step):
            yield a[k : k + step], ((self.points[a[k : k + step], None] - self.points[None, b]) ** 2).sum(-1)


def dbscan(points: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Density clusters of points (x, y): labels from 0, noise -1; a core point has `least` points, itself included, within eps. Clusters are
    numbered by their first core points, and a point near several of them belongs to the first.

    Points meet by cells of eps / sqrt(2) (after Gunawan, 2013): a cell with `least` points is dense without a distance taken, cells are
    joined by one pair of core points within eps, and memory follows the number of points.
    """
    n = len(points)
    labels = np.full(n, -1)
    if not n:
        return labels
    points = np.asarray(points, float)
    if eps <= 0 or not np.isfinite(points).all():
        raise ValueError("eps must be positive and points finite")
    if n <= 128:
        return _few(points, eps, least)
    grid = _Cells(points, eps)
    core = np.zeros(n, bool)
    for cell, own in grid.cells.items():
        if len(own) >= least:
            core[own] = True
            continue
        others = np.concatenate([x for _, x in grid.near(cell)])
        for some, d in grid.distances(own, others):
            core[some] = (d <= grid.limit).sum(1) >= least
    cores = {c: own[core[own]] for c, own in grid.cells.items() if core[own].any()}
    names = list(cores)
    place = {c: k for k, c in enumerate(names)}
    edges = []
    for c in names:
        for o, _ in grid.near(c):
            if o in cores and o > c and any((d <= grid.limit).any() for _, d in grid.distances(cores[c], cores[o])):
                edges.append((place[c], place[o]))
    part = single_linkage(len(names), np.array(edges, int).reshape(-1, 2), np.zeros(len(edges)), 1.0)
    first = np.full(part.max() + 1 if len(names) else 0, n)
    for c, k in place.items():
        first[part[k]] = min(first[part[k]], cores[c][0])
    number = np.empty(len(first), int)
    number[np.argsort(first)] = np.arange(len(first))
    for c, k in place.items():
        labels[cores[c]] = number[part[k]]
    for cell, own in grid.cells.items():
        rest = own[~core[own]]
        around = [x[core[x]] for _, x in grid.near(cell)] if len(rest) else []
        around = np.concatenate(around) if around else np.empty(0, int)
        if len(around):
            for some, d in grid.distances(rest, around):
                best = np.where(d <= grid.limit, labels[around][None], n).min(1)
                labels[some] = np.where(best < n, best, -1)
    return labels


def _few(points: np.ndarray, eps: float, least: int) -> np.ndarray:
    """dbscan() of so few points that all meet all."""
    n = len(points)
    near = ((points[:, None] - points[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    reach = near & core  # of a row the core points within eps
    part = np.where(core, np.arange(n), n)
    while True:
        lower = np.where(core, np.where(reach, part, n).min(1, initial=n), n)
        if (lower == part).all():
            break
        part = lower
    part = np.where(core, part, np.where(reach, part, n).min(1, initial=n))
    return np.where(part < n, np.searchsorted(np.unique(part[core]), part), -1)


def single_linkage(n: int, edges: np.ndarray, lengths: np.ndarray, cut: float) -> np.ndarray:
    """Component labels of the graph with the edges no longer than `cut`."""
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for (a, b), d in zip(edges, lengths):
        if d <= cut:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return np.unique([find(i) for i in range(n)], return_inverse=True)[1] if n else root


@lru_cache(maxsize=4096)
def _draws(n: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different places below n."""
    rng = np.random.default_rng(seed)
    pairs = np.array([rng.choice(n, 2, replace=False) for _ in range(rounds)])
    return pairs[:, 0], pairs[:, 1]


def ransac_line(x: np.ndarray, y: np.ndarray, tolerance: float, rounds: int = 100, seed: int = 0) -> tuple[float, float, np.ndarray]:
    """(slope, intercept, inliers) of the line that most points keep within `tolerance` of, refitted to those."""
    i, j = _draws(len(x), rounds, seed)
    fine = x[i] != x[j]
    i, j = i[fine], j[fine]
    best, most = np.zeros(len(x), bool), 0
    step = max(1, 200_000 // max(1, len(x)))
    for a in range(0, len(i), step):  # the first of those that most points keep to
        p, q = i[a : a + step], j[a : a + step]
        m = (y[q] - y[p]) / (x[q] - x[p])
        ok = np.abs(y - (y[p, None] + m[:, None] * (x - x[p, None]))) <= tolerance
        n = ok.sum(1)
        k = int(n.argmax())
        if n[k] > most:
            best, most = ok[k], n[k]
    if best.sum() < 2 or np.ptp(x[best]) == 0:
        return 0.0, float(np.median(y)) if len(y) else 0.0, np.abs(y - (np.median(y) if len(y) else 0)) <= tolerance
    m, c = np.polyfit(x[best], y[best], 1)
    return float(m), float(c), best


def kalman_smooth(z: np.ndarray, order: int = 4, process: float = 1e-2, noise: float = 4.0, dt: float = 1.0) -> np.ndarray:
    """The positions of kalman_states()."""
    return kalman_states(z, order, process, noise, dt)[:, 0]


def kalman_states(z: np.ndarray, order: int = 4, process: float = 1e-2, noise: float = 4.0, dt: float = 1.0) -> np.ndarray:
    """Rows of position, speed, acceleration and so on of a constant-derivative model of `order` states, filtered forward and smoothed backward
    (Rauch, Tung and Striebel); process noise is white on the highest derivative."""
    n, z = len(z), np.asarray(z, float)
    if n < 2:
        return np.c_[z, np.zeros((n, order - 1))]
    a, gains, back = _gains(order, process, noise, dt, max(128, 1 << (n - 1).bit_length()))
    if n <= 128:
        return np.tensordot(_smoother(order, process, noise, dt, n), z, ([2], [0]))
    xp, xs = np.empty((n, order)), np.empty((n, order))
    x = np.r_[z[0], np.zeros(order - 1)]
    for k in range(n):
        if k:
            x = a @ x
        xp[k] = x
        xs[k] = x = x + gains[k] * (z[k] - x[0])
    result = xs.copy()
    for k in range(n - 2, -1, -1):
        result[k] += back[k] @ (result[k + 1] - xp[k + 1])
    return result


@lru_cache(maxsize=8)
def _gains(order: int, process: float, noise: float, dt: float, n: int):
    """(step, filter gains, smoother gains) of the first n places; none depend on what is seen."""
    a = np.array([[dt ** (j - i) / factorial(j - i) if j >= i else 0.0 for j in range(order)] for i in range(order)])
    q = np.array([[dt ** (2 * order - 1 - i - j) / ((2 * order - 1 - i - j) * factorial(order - 1 - i) * factorial(order - 1 - j)) for j in range(order)] for i in range(order)]) * process
    p, gains, back = np.eye(order) * 1e3, [], []
    for k in range(n):
        if k:
            ahead = a @ p @ a.T + q
            back.append(np.linalg.solve(ahead, a @ p).T)
            p = ahead
        gains.append(p[:, 0] / (p[0, 0] + noise))
        p = p - np.outer(gains[-1], p[0])
        p = (p + p.T) / 2
    return a, np.array(gains), np.array(back)


@lru_cache(maxsize=256)
def _smoother(order: int, process: float, noise: float, dt: float, n: int) -> np.ndarray:
    """(n, order, n): what a short series of n places is multiplied with, for filter and smoother are linear in it."""
    a, gains, back = _gains(order, process, noise, dt, 128)
    xp, xs = np.zeros((n, order, n)), np.zeros((n, order, n))
    x = np.zeros((order, n))
    x[0, 0] = 1.0
    for k in range(n):
        if k:
            x = a @ x
        xp[k] = x
        off = -x[0]
        off[k] += 1
        xs[k] = x = x + np.outer(gains[k], off)
    for k in range(n - 2, -1, -1):
        xs[k] += back[k] @ (xs[k + 1] - xp[k + 1])
    return xs


def apart(places: np.ndarray, heights: np.ndarray, least: int) -> np.ndarray:
    """Of ascending places the highest, without those nearer than `least` to a higher one that stays; of equals the later stays."""
    places, stays = np.asarray(places, int), np.ones(len(places), bool)
    for k in np.argsort(heights, kind="stable")[::-1]:
        if stays[k]:
            near = np.abs(places - places[k]) < least
            near[k] = False
            stays &= ~near
    return places[stays]


def merged(spans: list[tuple[int, int]], share: float = 0.5) -> list[tuple[int, int]]:
    """Spans [start, end] in order of their starts, each as one with the one before if they share `share` of the shorter one's places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and min(b, out[-1][1]) - a + 1 >= share * (1 + min(b - a, out[-1][1] - out[-1][0])):
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def true_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """[start, end] of runs of true, both inclusive."""
    m = np.concatenate([[False], np.asarray(mask, bool), [False]])
    turn = np.flatnonzero(m[1:] != m[:-1])
    return list(zip(turn[::2].tolist(), (turn[1::2] - 1).tolist()))
