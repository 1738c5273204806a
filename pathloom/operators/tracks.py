"""Order-dependent operators on tracks, one group at a time: splitting, smoothing, spike repair, stitching, clusters, ball pieces.

A group is an entity or a (match, team); memory is bounded by it, or, in stitching, by what is active of it. Everything else on tracks is in tall.py and stats.py.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import numerics as N
from ..functions.labels import letters
from ..session import ship


def _schema(df: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    names = {n for n, _ in more}
    return T.StructType([f for f in df.schema if f.name not in names] + [T.StructField(n, t) for n, t in more])


def _grouped(df: DataFrame, by: list[str], f, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.groupBy(*by).applyInPandas(f, schema)


def split_by_label(df: DataFrame, by: list[str], order: str, label: str, window: int = 20, share: float = 0.9) -> DataFrame:
    """Adds `piece` (a, b, ..., z, aa, ...): a track is cut where, from a row of another label on, a label other than the current one
    has `share` of the next `window` rows. A window is only looked at where it fits."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        lab, n = g[label].to_numpy(), len(g)
        piece, out, cur = 0, np.zeros(n, int), lab[0] if n else None
        for i in range(n):
            if lab[i] != cur and i + window <= n:
                values, counts = np.unique(lab[i : i + window], return_counts=True)
                k = int(counts.argmax())
                if values[k] != cur and counts[k] >= share * window:
                    piece, cur = piece + 1, values[k]
            out[i] = piece
        return g.assign(piece=[letters(int(p)) for p in out])

    return _grouped(df, by, work, _schema(df, ("piece", T.StringType())))


def smooth(df: DataFrame, by: list[str], order: str, values: list[str], window: int = 91, degree: int = 7) -> DataFrame:
    """Savitzky-Golay smoothing of the columns `values` in place."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        return g.assign(**{v: N.savgol(g[v].to_numpy(float), window, degree) for v in values})

    return _grouped(df, by, work, df.schema)


def _monotony(y: np.ndarray) -> float:
    """How cleanly a curve rises to its peak and falls after it, or the other way round: the mean share of steps in the right direction."""
    if len(y) < 5:
        return 0.0
    d, best = np.diff(y), 0.0
    for sign, at in ((1, int(y.argmax())), (-1, int(y.argmin()))):
        if 0 < at < len(y) - 1:
            best = max(best, ((sign * d[:at] > 0).mean() + (sign * d[at:] < 0).mean()) / 2)
    return float(best)


def _curvature(y: np.ndarray) -> float:
    """The size of the square term of a parabola through a curve over [-1, 1]."""
    if len(y) < 5:
        return 0.0
    t = np.linspace(-1, 1, len(y))
    return abs(float(np.polyfit(t, y, 2)[0]))


def spike_mask(
    x: np.ndarray, y: np.ndarray, window: int = 301, step: int = 60, prominence: float = 2.0, shortest: int = 6, longest: int = 60, speed: float | None = None, steepness: float = 0.2, curvature: float = 0.08, monotony: float = 0.6, gap: int = 10
) -> np.ndarray:
    """Sharp waves: where the path leaves the main direction of its surroundings.

    In windows of `window` points, `step` apart, the second principal component is smoothed. Its peaks and valleys of enough prominence are
    widened as far as it falls off, and kept if they are neither too short nor too long, steep (amplitude over duration), curved, clean
    (monotony) and, with `speed`, faster than the mean by so many deviations. Gaps of at most `gap` between them are filled.
    """
    n = len(x)
    p, mask = np.c_[x, y].astype(float), np.zeros(len(x), bool)
    if n < 7:
        return mask
    pace = np.sqrt((np.diff(p, axis=0) ** 2).sum(1))
    fast = pace.mean() + speed * pace.std() if speed is not None else 0.0
    window = max(21, window)
    for a in range(0, max(1, n - window + 1), max(1, step)):
        q = p[a : a + window]
        if len(q) < 7:
            continue
        c = q - q.mean(0)
        z = N.savgol(c @ np.linalg.svd(c, full_matrices=False)[2][1], 7, 2)
        for s in (z, -z):
            for k in N.peaks(s, prominence):
                lo = hi = k
                while lo > 0 and s[lo - 1] < s[lo]:
                    lo -= 1
                while hi < len(s) - 1 and s[hi + 1] < s[hi]:
                    hi += 1
                wave, n_wave = z[lo : hi + 1], hi - lo + 1
                fits = shortest <= n_wave <= longest and np.ptp(wave) / n_wave >= steepness and _curvature(wave) >= curvature and _monotony(wave) >= monotony
                if fits and pace[a + lo : a + hi].mean() >= fast:
                    mask[a + lo : a + hi + 1] = True
    for (_, e), (s, _) in zip(N.true_runs(mask), N.true_runs(mask)[1:]):
        if s - e - 1 <= gap:
            mask[e : s + 1] = True
    return mask


def without_waves(x: np.ndarray, y: np.ndarray, mask: np.ndarray | None = None, **options) -> np.ndarray:
    """The points (x, y) with sharp waves, those of `mask` if it is known, replaced by straight lines between their neighbours."""
    out = np.c_[x, y].astype(float)
    for a, b in N.true_runs(spike_mask(x, y, **options) if mask is None else mask):
        lo, hi = max(a - 1, 0), min(b + 1, len(out) - 1)
        out[lo : hi + 1] = np.linspace(out[lo], out[hi], hi - lo + 1)
    return out


def repair_spikes(df: DataFrame, by: list[str], order: str, **options) -> DataFrame:
    """Replaces sharp waves of x and y by straight lines between their neighbours, and adds `repaired`."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        x, y = g["x"].to_numpy(float), g["y"].to_numpy(float)
        mask = spike_mask(x, y, **options)
        path = without_waves(x, y, mask)
        return g.assign(x=path[:, 0], y=path[:, 1], repaired=mask)

    return _grouped(df, by, work, _schema(df, ("repaired", T.BooleanType())))


class _Ends:
    """Where tracks ended lately. Starts ascend, so an end comes into view once and leaves for good. Ends in view lie by place, in cells of
    reach / 32: of each place a heap of (track, serial), of which those of an older serial than the track's own don't count."""

    def __init__(self, most_gap: int, most_overlap: int, reach: float):
        self.gap, self.overlap, self.reach, self.size = most_gap, most_overlap, reach, max(reach, 1e-9) / 32
        self.later, self.until = [], []  # heaps by end: those to come into view, those that will leave it
        self.cells: dict[tuple[int, int], dict[tuple[float, float], list]] = {}
        self.serial, self.own = 0, {}

    def add(self, track: int, end: int, x: float, y: float) -> None:
        self.serial += 1
        if math.isfinite(x) and math.isfinite(y):
            heapq.heappush(self.later, (end, self.serial, track, x, y))

    def _cell(self, x: float, y: float) -> tuple[int, int]:
        return math.floor(x / self.size), math.floor(y / self.size)

    def _oldest(self, cell: tuple[int, int], place: tuple[float, float]) -> int | None:
        """The oldest track that ended at a place; places and cells that have become empty go."""
        heap = self.cells[cell][place]
        while heap and self.own.get(heap[0][0]) != heap[0][1]:
            heapq.heappop(heap)
        if heap:
            return heap[0][0]
        del self.cells[cell][place]
        if not self.cells[cell]:
            del self.cells[cell]

    def _forward(self, start: int) -> None:
        while self.later and self.later[0][0] <= start + self.overlap:
            end, serial, track, x, y = heapq.heappop(self.later)
            heapq.heappush(self.until, (end, serial, track, x, y))
            heapq.heappush(self.cells.setdefault(self._cell(x, y), {}).setdefault((x, y), []), (track, serial))
            self.own[track] = serial
        while self.until and self.until[0][0] < start - self.gap:
            _, serial, track, x, y = heapq.heappop(self.until)
            if self.own.get(track) == serial:
                del self.own[track]
                self._oldest(self._cell(x, y), (x, y))

    def _rings(self, cx: int, cy: int):
        """(least distance, cells) about a cell, nearest first; where few cells are in use, all farther ones at once."""
        for r in range(34):
            if 8 * r > len(self.cells):
                yield (r - 1) * self.size, [c for c in self.cells if max(abs(c[0] - cx), abs(c[1] - cy)) >= r]
                return
            side = range(cx - r, cx + r + 1)
            yield (r - 1) * self.size, {(i, j) for j in (cy - r, cy + r) for i in side} | {(i, j) for i in (cx - r, cx + r) for j in range(cy - r, cy + r + 1)}

    def take(self, start: int, x: float, y: float) -> int | None:
        """The track that ended next to a piece's start, of equals the oldest; it leaves the view."""
        self._forward(start)
        if not (math.isfinite(x) and math.isfinite(y)):
            return None
        best, near = self.reach * (1 + 1e-9), []
        for least, cells in self._rings(*self._cell(x, y)):
            if least > best:
                break
            for cell in cells:
                for place in list(self.cells.get(cell, ())):
                    d = math.hypot(place[0] - x, place[1] - y)
                    if d <= best * (1 + 1e-9) and (track := self._oldest(cell, place)) is not None:
                        best = min(best, d)
                        near.append((d, track, place, cell))
        near = [(float(np.hypot(p[0] - x, p[1] - y)), t, p, c) for d, t, p, c in near if d <= best * (1 + 1e-9)]
        d, track, place, cell = min(near, default=(math.inf, None, None, None))
        if d > self.reach:
            return None
        del self.own[track]
        self._oldest(cell, place)
        return track


def stitch(pieces: DataFrame, by: list[str], most_gap: int = 20, most_overlap: int = 15, reach: float = 50.0, alone: int | None = None) -> DataFrame:
    """Adds `track` to rows (by, piece, start, end, x0, y0, x1, y1): pieces of a team are joined, each once, in order of start and
    id: to the nearest active track that ended 0 to most_gap frames before, or overlaps by 1 to most_overlap, and ends within reach.

    Each choice follows from those before, so a group streams through one task in that order; the task holds the ends of tracks that a
    piece may yet go on, by place, and no pairs. `alone` is of no effect any more.
    """
    ship(pieces.sparkSession)
    names = pieces.columns

    def work(batches):
        of, ends, first, last = None, None, [], []  # of each track of a group its first piece and its end
        for batch in batches:
            number = lambda c: [math.nan if v is None else v for v in batch.column(c).to_pylist()]
            out = []
            for key, piece, start, end, x0, y0, x1, y1 in zip(batch.column("_key").to_pylist(), batch.column("piece").to_pylist(), *map(number, ("start", "end", "x0", "y0", "x1", "y1"))):
                if key != of:
                    of, ends, first, last = key, _Ends(most_gap, most_overlap, reach), [], []
                track = ends.take(start, x0, y0)
                if track is None:
                    track = len(first)
                    first.append(piece)
                    last.append(end)
                last[track] = max(last[track], end)
                ends.add(track, last[track], x1, y1)
                out.append(first[track])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, batch.column("piece").type)], [*names, "track"])

    rows = pieces.withColumn("_key", F.to_json(F.struct(*by), {"ignoreNullFields": "false"})).repartition("_key").sortWithinPartitions("_key", "start", "piece")
    return rows.mapInArrow(work, _schema(pieces, ("track", pieces.schema["piece"].dataType)))


def _kth_distances(z: np.ndarray, k: int) -> np.ndarray:
    """The distance of each point to its k-th nearest other one (the farthest if there are fewer). Points ascend along the first axis, and
    a search stops where that axis alone is farther than the k-th found, so work follows the crowd about a point, not the square."""
    n, out = len(z), np.empty(len(z))
    k = min(k, n - 1)
    for i in range(n):
        reach = 2 * k + 1
        while True:
            a, b = max(0, i - reach), min(n, i + reach + 1)
            d = np.partition(np.sqrt(((z[a:b] - z[i]) ** 2).sum(1)), k)[k] if b - a > k else np.inf
            if (a == 0 or z[i, 0] - z[a, 0] >= d) and (b == n or z[b - 1, 0] - z[i, 0] >= d):
                break
            reach *= 2
        out[i] = d
    return out


def ball_outliers(df: DataFrame, by: list[str], order: str, k: int = 10, weight: float = 6.0, least: int = 3) -> DataFrame:
    """Drops points in clusters below `least`: z-scores with frames weighted, links to the five next points in time that are no longer
    than twice the median distance to the k-th nearest, single linkage."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        p = g[[order, "x", "y"]].to_numpy(float)
        if len(p) < least:
            return g.iloc[:0]
        z = (p - p.mean(0)) / np.where(p.std(0) > 0, p.std(0), 1) * [weight, 1, 1]
        far = _kth_distances(z, k)
        edges = np.array([(i, j) for i in range(len(z)) for j in range(i + 1, min(i + 6, len(z)))]).reshape(-1, 2)
        lengths = np.sqrt(((z[edges[:, 0]] - z[edges[:, 1]]) ** 2).sum(1)) if len(edges) else np.empty(0)
        lab = N.single_linkage(len(z), edges, lengths, 2 * float(np.median(far)))
        return g[np.bincount(lab)[lab] >= least]

    return _grouped(df, by, work, df.schema)


def static_clusters(df: DataFrame, by: list[str], order: str, size: int = 30, step: int = 15, eps: float = 15.0, least: int = 5, extent: float = 10.0, span: int = 5) -> DataFrame:
    """Drops points that stand: in some window a density cluster that is smaller than `extent` and lasts longer than `span`."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        f, p, drop = g[order].to_numpy(), g[["x", "y"]].to_numpy(float), np.zeros(len(g), bool)
        for a in range(int(f.min()), int(f.max()) + 1, step) if len(g) else ():
            i = np.arange(np.searchsorted(f, a), np.searchsorted(f, a + size))
            lab = N.dbscan(p[i], eps, least)
            for c in range(lab.max() + 1 if len(lab) else 0):
                m = i[lab == c]
                if np.ptp(p[m], axis=0).max() < extent and np.ptp(f[m]) > span:
                    drop[m] = True
        return g[~drop]

    return _grouped(df, by, work, df.schema)


def kalman(df: DataFrame, by: list[str], order: str, factor: float = 5.0, rounds: int = 10) -> DataFrame:
    """Smooths x and y by a four-state model; points whose residual is `factor` medians or more are replaced, again and again, until
    the limits move by less than a twentieth."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        for c in ("x", "y"):
            z, last = g[c].to_numpy(float), None
            for _ in range(rounds):
                s = N.kalman_smooth(z)
                r = np.abs(z - s)
                limit = factor * float(np.median(r)) if len(r) else 0.0
                z = np.where((r >= limit) & (limit > 0), s, z)
                if last is not None and abs(limit - last) <= 0.05 * max(last, 1e-12):
                    break
                last = limit
            g[c] = N.kalman_smooth(z)
        return g

    return _grouped(df, by, work, df.schema)


def straight_pieces(x: np.ndarray, y: np.ndarray, chunk: int = 2000, overlap: int = 200, residual: float = 8.0, least: int = 25) -> list[tuple[int, int, int]]:
    """(start, end, points) of runs of more than `least` points that stay on one line, by random samples on overlapping chunks in either direction."""
    found = set()
    for a in range(0, max(1, len(x)), chunk - overlap):
        i = np.arange(a, min(len(x), a + chunk))
        for u, v in ((x, y), (y, x)):  # both regressions: steep pieces are straight in one of them only
            free = np.ones(len(i), bool)
            while free.sum() > least:
                j = i[free]
                ok = N.ransac_line(u[j], v[j], residual)[2]
                runs = [(s, e) for s, e in N.true_runs(ok) if e - s + 1 > least]
                if not runs:
                    break
                found |= {(int(j[s]), int(j[e]), e - s + 1) for s, e in runs}
                free[np.flatnonzero(free)[ok]] = False
    return sorted(found)


def line_pieces(df: DataFrame, by: list[str], order: str, chunk: int = 2000, overlap: int = 200, residual: float = 8.0, least: int = 25) -> DataFrame:
    """(by, start, end, n): the straight_pieces() of a group's path, as values of `order`."""
    keys = [df.schema[c] for c in by]

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        f, x, y = g[order].to_numpy(), g["x"].to_numpy(float), g["y"].to_numpy(float)
        found = [(int(f[a]), int(f[b]), n) for a, b, n in straight_pieces(x, y, chunk, overlap, residual, least)]
        return pd.DataFrame([(*[g[c].iloc[0] for c in by], *t) for t in found], columns=[*by, "start", "end", "n"])

    return _grouped(df, by, work, T.StructType([*keys, T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("n", T.LongType())]))


def fuse_ball(df: DataFrame, by: list[str], order: str, conf: float = 0.25) -> DataFrame:
    """One ball for each frame: first the surest, later the one nearest to the pick before."""

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g[g["conf"] >= conf].sort_values([order, "conf", "x", "y"], ascending=[True, False, True, True], kind="stable")
        rows, at = [], None
        for _, h in g.groupby(order, sort=True):
            i = 0 if at is None else int(np.hypot(h["x"] - at[0], h["y"] - at[1]).to_numpy().argmin())
            rows.append(h.iloc[[i]])
            at = (h["x"].iloc[i], h["y"].iloc[i])
        return pd.concat(rows) if rows else g

    return _grouped(df, by, work, df.schema)
