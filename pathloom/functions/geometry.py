"""Plane geometry as column expressions. Coordinates are doubles; nulls give null."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Binds a value once for the expression that `body` makes of it."""
    return F.transform(F.array(value), body)[0]


def distance(x1, y1, x2, y2) -> Column:
    """Euclidean distance; plain arithmetic, so that every engine gives the same double."""
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def angle_between(ax, ay, bx, by) -> Column:
    """Angle between two vectors in degrees; 0 if one is zero. The cosine is clipped to [-1, 1]."""
    size = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / size))
    return F.when(size == 0, 0.0).otherwise(F.degrees(F.acos(cosine)))


def joint_angle(ax, ay, bx, by, cx, cy) -> Column:
    """Angle at b of the path a-b-c, with 1e-6 added to the denominator."""
    ux, uy, vx, vy = ax - bx, ay - by, cx - bx, cy - by
    size = F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy) + 1e-6
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ux * vx + uy * vy) / size))))


def homography(h, x, y) -> tuple[Column, Column]:
    """A point under a 3x3 matrix given as nine numbers or columns, row by row."""
    h = [v if isinstance(v, Column) else F.lit(float(v)) for v in np.asarray(h, object).ravel()]
    w = h[6] * x + h[7] * y + h[8]
    return (h[0] * x + h[1] * y + h[2]) / w, (h[3] * x + h[4] * y + h[5]) / w


def inverse_homography(h) -> np.ndarray:
    """The matrix that undoes `h`, scaled so that its last entry is 1."""
    inv = np.linalg.inv(np.asarray(h, float).reshape(3, 3))
    return inv / inv[2, 2]


def fit_homography(source, target, tolerance: float = 5.0, rounds: int = 500, seed: int = 0) -> np.ndarray:
    """The matrix that takes `source` points to `target` points: exact for four pairs, otherwise by random samples of four and a
    least-squares fit to the pairs within `tolerance`. Fewer than four pairs raise ValueError."""
    a, b = np.asarray(source, float), np.asarray(target, float)
    if len(a) < 4 or len(a) != len(b):
        raise ValueError("at least four point pairs are needed")

    def solve(p, q):
        rows = []
        for (x, y), (u, v) in zip(p, q):
            rows += [[-x, -y, -1, 0, 0, 0, u * x, u * y, u], [0, 0, 0, -x, -y, -1, v * x, v * y, v]]
        h = np.linalg.svd(np.array(rows))[2][-1].reshape(3, 3)
        return h / h[2, 2] if abs(h[2, 2]) > 1e-12 else h

    def errors(h):
        p = np.c_[a, np.ones(len(a))] @ h.T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(np.hypot(*(p[:, :2] / p[:, 2:] - b).T), nan=np.inf)

    if len(a) == 4:
        return solve(a, b)
    rng, best = np.random.default_rng(seed), np.zeros(len(a), bool)
    for _ in range(rounds):
        pick = rng.choice(len(a), 4, replace=False)
        ok = errors(solve(a[pick], b[pick])) <= tolerance
        if ok.sum() > best.sum():
            best = ok
    return solve(a[best], b[best]) if best.sum() >= 4 else solve(a, b)


def warp_box(h, x1, y1, x2, y2) -> tuple[Column, Column, Column, Column]:
    """The bounding box of a box's four transformed corners."""
    corners = [homography(h, x, y) for x, y in ((x1, y1), (x2, y1), (x2, y2), (x1, y2))]
    xs, ys = zip(*corners)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def parse_points(text: Column) -> Column:
    """'x,y x,y ...' as an array of (x, y)."""
    return F.transform(F.split(F.trim(text), r"\s+"), lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y")))


def inside_polygon(x, y, points: list[tuple[Column, Column]]) -> Column:
    """Whether a point lies strictly inside a polygon: an odd number of edges to its right, and none that it stands on."""
    crossings, on_edge = F.lit(0), F.lit(False)
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1]):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        between = (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx)) & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by))
        on_edge = on_edge | ((F.abs(cross) < 1e-12) & between)
        spans = (ay > y) != (by > y)
        crossings = crossings + F.when(spans & (x < (bx - ax) * (y - ay) / (by - ay) + ax), 1).otherwise(0)
    return (crossings % 2 == 1) & ~on_edge


def in_bounds(x, y, width: float = 1060.0, height: float = 660.0) -> Column:
    return x.between(0.0, width) & y.between(0.0, height)


def near_edge(x, y, margin: float = 30.0, width: float = 1060.0, height: float = 660.0) -> Column:
    return F.least(x, y, F.lit(width) - x, F.lit(height) - y) < margin


def bin_index(v: Column, low: float, high: float, n: int) -> Column:
    """The bin of v among n equal ones; the last is closed at the top, values outside go to the outermost."""
    return F.greatest(F.lit(0), F.least(F.floor((v - low) / ((high - low) / n)), F.lit(n - 1))).cast("int")


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; null if one is zero."""
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def bhattacharyya_similarity(p: Column, q: Column) -> Column:
    """1 - sqrt(1 - sum sqrt(p q) / sqrt(mean p * mean q * n * n)) for two histograms."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, t: s + t.cast("double"))
    overlap = F.aggregate(F.zip_with(p, q, lambda u, v: F.sqrt(u.cast("double") * v.cast("double"))), F.lit(0.0), lambda s, t: s + t)
    size = F.sqrt(total(p) * total(q))
    return F.when(size > 0, 1 - F.sqrt(F.greatest(F.lit(0.0), 1 - overlap / size)))


def mask_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two 0/1 arrays, with 1e-7 added below."""
    both = F.aggregate(F.zip_with(a, b, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, t: s + t)
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, t: s + t.cast("double"))
    return both / (total(a) + total(b) - both + 1e-7)


def log_density(n: Column) -> Column:
    """The logarithm of a bin's count, 0 for an empty or missing one."""
    return F.when(n > 0, F.log(n.cast("double"))).otherwise(0.0)


def packed_mask(bits: Column) -> Column:
    """A mask (an array of booleans or 0 and 1, null for 0) as words of 64 bits; the last one may hold fewer."""
    count = F.ceil(F.size(bits) / 64).cast("int")
    word = lambda i: F.aggregate(F.slice(bits, i * 64 + 1, 64), F.lit(0).cast("long"), lambda w, b: F.shiftleft(w, 1).bitwiseOR(F.coalesce(b.cast("int").cast("long"), F.lit(0))))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), word)).otherwise(F.array().cast("array<bigint>"))


def packed_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two masks of one size, as packed_mask() makes them; null for masks of different sizes, 0 for empty ones."""
    total = lambda words: F.aggregate(words, F.lit(0).cast("long"), lambda s, w: s + F.bit_count(w))
    both, either = total(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))), total(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return F.when(F.size(a) == F.size(b), F.when(either > 0, both / either).otherwise(0.0))
