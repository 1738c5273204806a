"""Order-dependent kernels against plain versions."""

import random

import numpy as np

from pathloom import numerics as N
from pathloom.operators import tracks


def test_kth_distances():
    rng = np.random.default_rng(1)
    for n in (3, 12, 200):
        z = np.c_[np.sort(rng.random(n) * 50), rng.random((n, 2)) * rng.integers(1, 40)]
        plain = [np.sort(np.sqrt(((z[i] - z) ** 2).sum(1)))[min(10, n - 1)] for i in range(n)]
        assert np.allclose(tracks._kth_distances(z, 10), plain)


def test_savgol_is_a_local_fit():
    rng = np.random.default_rng(2)
    y = rng.random(60)
    got = N.savgol(y, 11, 3)
    for i in range(5, 55):
        assert np.isclose(got[i], np.polyval(np.polyfit(np.arange(-5, 6), y[i - 5 : i + 6], 3), 0))
    assert np.allclose(N.savgol(np.arange(30.0) ** 2, 7, 2), np.arange(30.0) ** 2)


def test_dbscan_and_linkage():
    rng = np.random.default_rng(3)
    p = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(50, 1, (30, 2)), [[200.0, 200.0]]])
    lab = N.dbscan(p, 5.0, 4)
    assert len(set(lab[:30])) == 1 == len(set(lab[30:60])) and lab[0] != lab[30] and lab[60] == -1
    edges = np.array([(i, i + 1) for i in range(9)])
    lab = N.single_linkage(10, edges, np.array([1, 1, 9, 1, 1, 1, 9, 1, 1.0]), 2.0)
    assert lab[0] == lab[2] != lab[3] == lab[6] != lab[7] == lab[9]


def test_kalman_smooth_follows_a_line():
    rng = np.random.default_rng(4)
    t = np.arange(200.0)
    z = 3 * t + rng.normal(0, 2, 200)
    assert np.abs(N.kalman_smooth(z) - 3 * t)[10:-10].mean() < np.abs(z - 3 * t)[10:-10].mean()


def test_stitch_against_a_plain_walk(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        start = rng.randrange(0, 400)
        rows.append((i % 2, i, start, start + rng.randrange(1, 40), *[float(rng.randrange(0, 200)) for _ in range(4)]))
    df = spark.createDataFrame(rows, "team long, piece long, start long, end long, x0 double, y0 double, x1 double, y1 double")
    got = {r.piece: r.track for r in tracks.stitch(df, ["team"]).collect()}
    for team in (0, 1):
        alive, want = [], {}
        for _, piece, start, end, x0, y0, x1, y1 in sorted((r for r in rows if r[0] == team), key=lambda r: (r[2], r[1])):
            alive = [t for t in alive if t["end"] >= start - 20]
            near = [(np.hypot(t["x"] - x0, t["y"] - y0), n) for n, t in enumerate(alive) if -15 <= start - t["end"] <= 20]
            if near and min(near)[0] <= 50:
                t = alive[min(near)[1]]
                t.update(end=max(t["end"], end), x=x1, y=y1)
            else:
                t = {"id": piece, "end": end, "x": x1, "y": y1}
                alive.append(t)
            want[piece] = t["id"]
        assert all(got[p] == w for p, w in want.items())


def test_static_points_go(spark):
    rows = [(1, f, 500.0 if 100 <= f < 160 else 10.0 * f, 300.0) for f in range(300)]
    kept = tracks.static_clusters(spark.createDataFrame(rows, "m long, f long, x double, y double"), ["m"], "f").collect()
    frames = {r.f for r in kept}
    assert not frames & set(range(105, 155)) and set(range(0, 90)) <= frames and set(range(170, 300)) <= frames


def test_lone_points_go(spark):
    rows = [(1, f, 5.0 * f, 100.0) for f in range(100)] + [(1, 50, 4000.0, 3000.0)]
    kept = tracks.ball_outliers(spark.createDataFrame(rows, "m long, f long, x double, y double"), ["m"], "f").collect()
    assert (4000.0, 3000.0) not in {(r.x, r.y) for r in kept} and len(kept) >= 95
