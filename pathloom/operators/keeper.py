"""Tags of a goalkeeper clip from skeletons of 17 points and the ball; one clip is one group.

Point numbers follow the common 17-point order: 3, 4 ears; 5, 6 shoulders; 7, 8 elbows; 9, 10 wrists; 11, 12 hips; 13, 14 knees; 15, 16 ankles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..session import ship


@dataclass(frozen=True)
class Limits:
    distance: float = 120.0
    movement: float = 60.0
    speed: float = 15.0
    jump: float = 20.0
    elbow: float = 110.0
    left_area: float = 2500.0
    right_area: float = 0.0


def _angles(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    u, v = a - b, c - b
    dot = lambda p, q: (p[:, None, :] @ q[:, :, None])[:, 0, 0]
    return np.degrees(np.arccos(np.clip(dot(u, v) / (np.sqrt(dot(u, u)) * np.sqrt(dot(v, v)) + 1e-6), -1, 1)))


def _inside(p: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """Whether each point lies in its polygon."""
    a, b, x, y = poly, np.roll(poly, -1, axis=1), p[:, :1], p[:, 1:]
    with np.errstate(all="ignore"):
        cut = ((a[..., 1] > y) != (b[..., 1] > y)) & (x < (b[..., 0] - a[..., 0]) * (y - a[..., 1]) / (b[..., 1] - a[..., 1]) + a[..., 0])
    return cut.sum(1) % 2 == 1


def _points(skeleton) -> np.ndarray:
    """17 x 2 numbers, missing points as nan."""
    return np.array([(np.nan, np.nan) if p is None or any(v is None for v in p) else p for p in skeleton], float)


def tags(skeletons: list, balls: list, ball_speed: float | None, lim: Limits = Limits()) -> list[int]:
    """Tags of one clip: `skeletons` (17 points, each of which may be missing, or None) and `balls` (x1, y1, x2, y2, or None) by frame; [0]
    if none applies."""
    frames = [(_points(s), np.asarray(b, float)) for s, b in zip(skeletons, balls) if s is not None and b is not None]
    if not any(s is not None for s in skeletons) or not any(b is not None for b in balls):
        return [0]
    s, b = (np.stack(x) for x in zip(*frames)) if frames else (np.empty((0, 17, 2)), np.empty((0, 4)))
    return _tags(s, b, ball_speed, lim)


def _tags(s: np.ndarray, b: np.ndarray, ball_speed: float | None, lim: Limits) -> list[int]:
    """tags() of frames that have both: points (frames, 17, 2) and balls (frames, 4)."""
    slow = ball_speed is not None and ball_speed < lim.speed
    out: set[int] = set()
    there = lambda i: np.isfinite(s[:, i]).all((1, 2))
    far = lambda v: np.hypot(v[..., 0], v[..., 1])
    c, size = np.c_[(b[:, 0] + b[:, 2]) / 2, (b[:, 1] + b[:, 3]) / 2], (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    legs = [11, 12, 14, 16, 15, 13]
    if (_inside(np.c_[c[:, 0], b[:, 1]], s[:, legs]) & there(legs)).any():
        out.add(10)
    arms = ((5, 7, 9), (6, 8, 10))
    upper = np.stack([there([sh, el]) for sh, el, _ in arms], 1)
    length = np.stack([2 * far(s[:, sh] - s[:, el]) for sh, el, _ in arms], 1)
    reach = np.maximum.accumulate(np.where(upper, length, 0.0).ravel()).reshape(-1, 2)  # of either arm, seen so far
    for k, ((sh, el, wr), least) in enumerate(zip(arms, (lim.left_area, lim.right_area))):
        whole = upper[:, k] & there([wr])
        angle = _angles(s[whole, sh], s[whole, el], s[whole, wr])
        hits = upper[:, k] & (far(s[:, sh] - c) <= reach[:, k]) & (size > least)
        out |= {9} if slow and hits.any() else set()
        n = np.cumsum(whole)[hits]
        n = n[n > 0]
        falls = np.r_[0, np.cumsum(angle[1:] < angle[:-1])]  # up to each angle; the last ten count
        out |= {7} if len(n) and (falls[n - 1] > falls[np.maximum(n - 10, 0)]).any() else set()
        out |= {6} if len(n) and (angle[n - 1] < lim.elbow).any() else set()
    fine = lambda v: v[np.isfinite(v)]
    feet, elbows, ears = [fine(s[:, i, 1]) for i in (15, 16)], [fine(s[:, i, 1]) for i in (7, 8)], fine(s[:, [3, 4], 1].ravel())
    d = np.sqrt(((s - c[:, None]) ** 2).sum(2))
    near = np.where(np.isnan(d), np.inf, d).min(1)[np.isfinite(d).any(1)]
    trunk = [5, 6, 11, 12]
    body, ball = s[there(trunk)][:, trunk].mean(1), c[there(trunk)]
    if len(near) >= 10 and np.mean(near[-10:]) > lim.distance and len(body) > 1 and np.hypot(*(body[0] - body[-1])) < lim.movement:
        out |= {1, 2, 11}
    if len(body) >= 10:
        first, last, at = np.mean(body[:5], 0), np.mean(body[-5:], 0), np.mean(ball[-5:], 0)
        if np.hypot(*(last - at)) > np.hypot(*(first - at)):
            out.add(3)
    high = bool(len(ball) and len(ears)) and ball[-1][1] < np.mean(ears)  # image rows grow downwards
    if high and all(map(len, feet)) and sum(np.ptp(f) for f in feet) < lim.jump:
        out |= {4, 12}
    if high and any(map(len, elbows)) and max(e.min(initial=np.inf) if len(e) else 0.0 for e in elbows) > np.mean(ears):
        out.add(5)
    if slow:
        out.add(8)
    return sorted(out) or [0]


def classify(clips: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """(clip, tags) of rows (clip, frame, skel array<array<double>>, ball array<double>, ball_speed)."""
    ship(clips.sparkSession)

    def work(g: pa.Table) -> pa.Table:
        g = g.take(np.argsort(g.column("frame").to_numpy(), kind="stable"))
        speed = next((v for v in g.column("ball_speed").to_pylist() if v is not None and v == v), None)
        skel, ball = (g.column(c).combine_chunks() for c in ("skel", "ball"))
        both = pc.and_(skel.is_valid(), ball.is_valid())
        points, at = skel.filter(both), ball.filter(both)
        flat = points.flatten()
        if len(points) and not (flat.null_count or flat.flatten().null_count or at.flatten().null_count) and (flat.value_lengths().to_numpy() == 2).all() and (points.value_lengths().to_numpy() == 17).all() and (at.value_lengths().to_numpy() == 4).all():
            found = _tags(flat.flatten().to_numpy().reshape(-1, 17, 2), at.flatten().to_numpy().reshape(-1, 4), speed, lim)
        else:
            found = tags(skel.to_pylist(), ball.to_pylist(), speed, lim)
        return pa.table({"clip": g.column("clip").slice(0, 1).cast(pa.int64()), "tags": pa.array([found], pa.list_(pa.int32()))})

    return clips.select("clip", "frame", "skel", "ball", "ball_speed").groupBy("clip").applyInArrow(work, "clip long, tags array<int>")
