"""Operators that run several steps in one call: from raw track points to clean tracks, from ball detections to a smooth path; anchors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import numerics as N
from ..session import ship
from ..storage import stored
from . import filters, tall, tracks


def split_tracks(points: DataFrame, by: list[str], order: str, label: str, window: int = 20, share: float = 0.9, least: int = 10, width: float = 1060.0, height: float = 660.0) -> DataFrame:
    """Tracks cut where their label changes, without pieces of fewer than `least` points before or after points out of bounds are dropped:
    columns of `points` and piece."""
    cut = tracks.split_by_label(points, by, order, label, window, share)
    return filters.long_tracks(cut, [*by, "piece"], least, width, height)


def stitch_points(points: DataFrame, by: list[str], piece: str, order: str, window: int = 91, degree: int = 7, **rule) -> DataFrame:
    """(by, track, order, x, y, conf): pieces joined by tracks.stitch(), a point for every frame of a track, smoothed.

    Where joined pieces share frames the surer point stays; conf is null for points in between. A (team, match) is one task for its pieces,
    a track for its points.
    """
    a, z = F.min(F.struct(order, "x", "y")), F.max(F.struct(order, "x", "y"))
    ends = points.groupBy(*by, piece).agg(a.alias("a"), z.alias("z"))
    ends = ends.select(*by, F.col(piece).alias("piece"), F.col(f"a.{order}").alias("start"), F.col(f"z.{order}").alias("end"), F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("z.x").alias("x1"), F.col("z.y").alias("y1"))
    named = tracks.stitch(ends, by, **rule).select(*by, F.col("piece").alias(piece), "track")
    w = Window.partitionBy(*by, "track", order).orderBy(F.desc("conf"), piece)
    one = points.join(named, [*by, piece]).withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*by, "track", order, "x", "y", "conf")
    whole = tall.interpolate(one.select(*by, "track", order, "x", "y"), [*by, "track"], order, ["x", "y"]).select(*by, "track", order, "x", "y")
    smooth = tracks.smooth(whole, [*by, "track"], order, ["x", "y"], window, degree)
    return smooth.join(one.select(*by, "track", order, "conf"), [*by, "track", order], "left")


def static_free_ball(ball: DataFrame, width: float = 1060.0, height: float = 660.0, size: float = 5.0, primary: int = 50, secondary: int = 10, radius: float = 10.0) -> DataFrame:
    """Ball points in bounds that lie in no crowded cell."""
    from . import stats

    return stats.without_dense(ball.filter(F.col("x").between(0, width) & F.col("y").between(0, height)), size, primary, secondary, radius)


def knots(frame: np.ndarray, x: np.ndarray, y: np.ndarray, prominence: float = 3.0) -> np.ndarray:
    """Where a path turns: its ends and the peaks of its acceleration."""
    if len(x) < 5:
        return np.arange(len(x))
    step = np.maximum(np.diff(frame), 1)
    v = np.c_[np.diff(x) / step, np.diff(y) / step]
    a = np.r_[0.0, np.sqrt((np.diff(v, axis=0) ** 2).sum(1)), 0.0]
    return np.unique(np.r_[0, N.peaks(a, prominence), len(x) - 1]).astype(int)


def smooth_ball(ball: DataFrame, by: list[str], order: str, prominence: float = 3.0, residual: float = 8.0, least: int = 25, wave: dict | None = None) -> DataFrame:
    """A ball's path filtered (tracks.kalman), freed of sharp waves, and drawn anew: on straight pieces of `least` points and more, and from
    turn to turn within them, it is a straight line. Other points stay as the filter leaves them. One ball track is one task."""
    filtered = tracks.repair_spikes(tracks.kalman(ball, by, order), by, order, **(wave or {})).drop("repaired")
    ship(ball.sparkSession)

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        f, x, y = (g[c].to_numpy(float) for c in (order, "x", "y"))
        turns = knots(f, x, y, prominence)
        for a, b in zip(turns[:-1], turns[1:]):
            if b - a + 1 < least:
                continue
            u, v = (x, y) if np.ptp(x[a : b + 1]) >= np.ptp(y[a : b + 1]) else (y, x)
            straight = N.ransac_line(u[a : b + 1], v[a : b + 1], residual)[2]
            if straight.all():
                for c, values in (("x", x), ("y", y)):
                    g.loc[a:b, c] = np.interp(f[a : b + 1], [f[a], f[b]], [values[a], values[b]])
        return g

    return filtered.groupBy(*by).applyInPandas(work, filtered.schema)


def settled(x: np.ndarray, y: np.ndarray, factor: float = 5.0, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """(path, acceleration) of a point: either axis smoothed by a four-state model, again and again with points whose residual is `factor`
    medians or more replaced by the path, until the limits of both move by less than a twentieth."""
    z, last = np.c_[x, y].astype(float), None
    for _ in range(rounds):
        states = [N.kalman_states(z[:, k]) for k in (0, 1)]
        path = np.c_[states[0][:, 0], states[1][:, 0]]
        off = np.abs(path - np.c_[x, y])
        limit = factor * np.median(np.abs(path - z), axis=0)
        if last is not None and (np.abs(limit - last) < 0.05 * np.maximum(last, 1e-12)).all():
            break
        last = limit
        z = np.where((np.abs(path - z) < limit) | (off < limit), z, path)
    return path, np.hypot(states[0][:, 2], states[1][:, 2])


def vertices(frame: np.ndarray, acceleration: np.ndarray, pieces: list[tuple[int, int]], margin: int = 8, apart: int = 24, prominence: float = 10.0) -> np.ndarray:
    """The places where a path is pinned: its ends, both ends of every straight piece (one that two chunks or both directions
    found is one), and between pieces, `margin` frames from either, the peaks of acceleration, `apart` places from a higher one."""
    straight = N.merged([(a, b) for a, b, *_ in pieces])
    every = N.peaks(acceleration, 0.0)
    peaks = np.intersect1d(N.apart(every, acceleration[every], apart), N.peaks(acceleration, prominence))
    free = np.ones(len(peaks), bool)
    for a, b in straight:
        free &= (frame[peaks] >= frame[b] + margin) | (frame[peaks] <= frame[a] - margin)
    return np.unique(np.r_[0, len(frame) - 1, [k for s in straight for k in s], peaks[free]]).astype(int)


def ball_path(
    ball: DataFrame, by: list[str], order: str, static: dict | None = None, wave: dict | None = None, chunk: int = 2000, overlap: int = 200, residual: float = 8.0, least: int = 25, margin: int = 8, apart: int = 24, prominence: float = 10.0
) -> DataFrame:
    """(by, order, x, y) for every whole `order` from a ball's first to its last: what stands is dropped (tracks.static_clusters), the rest
    settled and freed of sharp waves, straight pieces and the turns between them found, and the path drawn anew as straight lines from one
    of those points to the next.

    A ball track, such as a match's, is one task up to its points; the frames between them are many. Groups without points that move give nothing.
    """
    moving = tracks.static_clusters(ball, by, order, **(static or {}))
    ship(ball.sparkSession)
    kind = T.StructType([*[moving.schema[c] for c in by], T.StructField(order, T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable").reset_index(drop=True)
        f = g[order].to_numpy()
        path, acceleration = settled(g["x"].to_numpy(float), g["y"].to_numpy(float))
        path = tracks.without_waves(path[:, 0], path[:, 1], **(wave or {}))
        at = vertices(f, acceleration, tracks.straight_pieces(path[:, 0], path[:, 1], chunk, overlap, residual, least), margin, apart, prominence)
        return g[by].iloc[at].assign(**{order: f[at], "x": path[at, 0], "y": path[at, 1]})

    pins = moving.select(*by, F.col(order).cast("long").alias(order), "x", "y").groupBy(*by).applyInPandas(work, kind)
    return tall.interpolate(stored(pins, "pins"), by, order, ["x", "y"]).select(*by, order, "x", "y")


class BallFilter:
    """A constant-velocity filter of a point in the plane, one step a frame. Both axes have one covariance, for nothing tells them apart."""

    def __init__(self, at: np.ndarray, spread: float = 100.0, noise: float = 50.0, process: float = 10.0):
        self.at, self.speed, self.cov = np.array(at, float), np.zeros(2), np.eye(2) * spread
        self.noise, self.process = noise, process

    def predict(self) -> np.ndarray:
        step = np.array([[1.0, 1.0], [0.0, 1.0]])
        self.at = self.at + self.speed
        self.cov = step @ self.cov @ step.T + np.eye(2) * self.process
        return self.at

    def update(self, seen: np.ndarray) -> None:
        gain = self.cov[:, 0] / (self.cov[0, 0] + self.noise)
        off = seen - self.at
        self.at, self.speed = self.at + gain[0] * off, self.speed + gain[1] * off
        self.cov = self.cov - np.outer(gain, self.cov[0])


class BallChoice:
    """Picks a ball among the candidates of each frame.

    The first frame's is the only one, or that nearest to the pitch's centre. Later a lone candidate counts unless it is farther than
    `jump` from the ball before. Of several the one of least cost does: its distance to where the filter expects the ball, plus its distance to
    the ball before (`jump_cost` if that is beyond `jump`), plus `static_cost` for every candidate of the last `window` frames within `still`
    of it. The filter moves on in frames that count.
    """

    def __init__(self, jump: float, still: float, window: int, static_cost: float, jump_cost: float, pitch: tuple[float, float]):
        self.jump, self.still, self.window, self.static_cost, self.jump_cost = jump, still, window, static_cost, jump_cost
        self.centre, self.filter, self.last = np.array(pitch) / 2, None, None
        self.recent: list[tuple[int, np.ndarray]] = []

    def _cheapest(self, here: np.ndarray, base: np.ndarray) -> int:
        """The first candidate of least base + static_cost * (candidates of the last frames within `still`). Some of those are counted by
        cells of still / 4 that lie wholly within reach, which bounds the cost from below; candidates are looked at by that bound."""
        before = np.concatenate([np.empty((0, 2)), *[p for _, p in self.recent]])
        before = before[np.isfinite(before).all(1)]
        if not len(before) or self.static_cost <= 0 or self.still <= 0:
            near = np.array([(np.sqrt(((before - p) ** 2).sum(1)) < self.still).sum() for p in here])
            return int((base + self.static_cost * near).argmin())
        size = self.still / 4
        column = np.floor(before[:, 0] / size).astype(np.int64)
        order = np.lexsort((before[:, 1], column))
        before, column = before[order], column[order]
        cells, at = np.unique(np.c_[column, np.floor(before[:, 1] / size)].astype(np.int64), axis=0, return_index=True)
        held = dict(zip(map(tuple, cells.tolist()), np.diff(np.r_[at, len(before)]).tolist()))
        sure = [(i, j) for i in range(-3, 4) for j in range(-3, 4) if (abs(i) + 1) ** 2 + (abs(j) + 1) ** 2 < 15.9]
        own = np.floor(np.where(np.isfinite(here), here, 0) / size).astype(np.int64)
        mine, back = np.unique(own, axis=0, return_inverse=True)
        least = np.array([sum(held.get((a + i, b + j), 0) for i, j in sure) for a, b in mine.tolist()])[back.ravel()]
        bound = np.where(np.isfinite(here).all(1), base + self.static_cost * least, base)
        best, k, seen = np.inf, 0, {}
        for c in np.argsort(bound, kind="stable").tolist():
            if bound[c] > best:
                break
            place = (here[c, 0], here[c, 1])
            if place not in seen:
                lo, hi = np.searchsorted(column, [own[c, 0] - 5, own[c, 0] + 6])
                seen[place] = int((np.sqrt(((before[lo:hi] - here[c]) ** 2).sum(1)) < self.still).sum())
            cost = base[c] + self.static_cost * seen[place]
            if cost < best or (cost == best and c < k):
                best, k = cost, c
        return k

    def pick(self, frame: int, here: np.ndarray) -> int | None:
        self.recent = [(f, p) for f, p in self.recent if f >= frame - self.window]
        k: int | None = 0
        if self.filter is None:
            k = int(np.sqrt(((here - self.centre) ** 2).sum(1)).argmin())
            self.filter = BallFilter(here[k])
        elif len(here) == 1:
            if np.sqrt(((here[0] - self.last) ** 2).sum()) > self.jump:
                k = None
            else:
                self.filter.predict()
                self.filter.update(here[0])
        else:
            far = np.sqrt(((here - self.filter.predict()) ** 2).sum(1))
            moved = np.sqrt(((here - self.last) ** 2).sum(1))
            base = far + np.where(moved > self.jump, self.jump_cost, moved)
            k = self._cheapest(here, base)
            self.filter.update(here[k])
        self.recent.append((frame, here))
        self.last = here[k] if k is not None else self.last
        return k


def pick_ball(candidates: DataFrame, by: list[str], order: str, jump: float = 150.0, still: float = 5.0, window: int = 5, static_cost: float = 50.0, jump_cost: float = 1000.0, pitch: tuple[float, float] = (1060.0, 660.0)) -> DataFrame:
    """One row of each frame (by, order, x, y) at most, as BallChoice says; ties go by x, then y. A group, such as a match, is a task; its
    frames go through one by one, and only the candidates of the last `window` frames are held beside the rows."""
    ship(candidates.sparkSession)

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([order, "x", "y"], kind="stable").reset_index(drop=True)
        f, p = g[order].to_numpy(), g[["x", "y"]].to_numpy(float)
        edges = np.flatnonzero(np.r_[True, f[1:] != f[:-1], True]) if len(f) else [0]
        choice = BallChoice(jump, still, window, static_cost, jump_cost, pitch)
        picks = [(a, choice.pick(int(f[a]), p[a:b])) for a, b in zip(edges[:-1], edges[1:])]
        return g.iloc[[a + k for a, k in picks if k is not None]]

    return candidates.groupBy(*by).applyInPandas(work, candidates.schema)


def anchors(boxes: DataFrame, n: int = 9, seed: int = 0) -> DataFrame:
    """(anchor, w, h): `n` typical sizes of boxes, smallest first, numbered from 0: the centres of k-means over sizes in units of their
    deviations. Rows with a size that is null or not a number don't count; without rows there are no anchors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    spark, schema = boxes.sparkSession, "anchor int, w double, h double"
    sizes = boxes.select(F.col("w").cast("double").alias("w"), F.col("h").cast("double").alias("h")).filter("w IS NOT NULL AND h IS NOT NULL AND NOT isnan(w) AND NOT isnan(h)")
    s = sizes.agg(F.stddev_pop("w").alias("w"), F.stddev_pop("h").alias("h")).first()
    if s.w is None:
        return spark.createDataFrame([], schema)
    unit = sizes.select((F.col("w") / F.lit(s.w or 1.0)).alias("w"), (F.col("h") / F.lit(s.h or 1.0)).alias("h"))
    model = KMeans(k=n, seed=seed, maxIter=30).fit(VectorAssembler(inputCols=["w", "h"], outputCol="features").transform(unit))
    centres = sorted(((float(a * (s.w or 1.0)), float(b * (s.h or 1.0))) for a, b in model.clusterCenters()), key=lambda c: c[0] * c[1])
    return spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(centres)], schema)
