"""Operators of several steps, on paths whose outcome is known."""

import numpy as np

from pathloom import numerics as N
from pathloom.operators import chains, tracks


def test_split_and_stitch(spark):
    rows = [("h", 1, f, "a" if f < 60 else "b", 4.0 * f + 10, 100.0, 0.9) for f in range(120)] + [("h", 2, f, "a", 4.0 * f + 10, 100.0, 0.8) for f in range(130, 180)] + [("h", 3, 1, "a", 900.0, 600.0, 0.5)]
    df = spark.createDataFrame(rows, "team string, entity long, frame long, label string, x double, y double, conf double")
    cut = chains.split_tracks(df, ["team", "entity"], "frame", "label")
    assert {(r.entity, r.piece, r["count"]) for r in cut.groupBy("entity", "piece").count().collect()} == {(1, "a", 60), (1, "b", 60), (2, "a", 50)}
    got = chains.stitch_points(df.filter("entity < 3"), ["team"], "entity", "frame", 11, 3).collect()
    assert {r.track for r in got} == {1} and sorted(r.frame for r in got) == list(range(180))
    assert all(abs(r.x - (4.0 * r.frame + 10)) < 1e-6 for r in got) and {r.frame for r in got if r.conf is None} == set(range(120, 130))


def test_smooth_ball(spark):
    rng = np.random.default_rng(1)
    x = np.r_[np.arange(80) * 6.0, 474 - np.arange(1, 81) * 6.0]
    y = 200 + np.r_[np.zeros(80), np.arange(1, 81) * 3.0]
    rows = [(1, f, float(x[f] + rng.normal(0, 0.5)), float(y[f] + rng.normal(0, 0.5))) for f in range(160)]
    rows[40] = (1, 40, 900.0, 600.0)
    got = sorted(chains.smooth_ball(spark.createDataFrame(rows, "m long, f long, x double, y double"), ["m"], "f").collect(), key=lambda r: r.f)
    off = np.hypot([r.x for r in got] - x, [r.y for r in got] - y)
    assert np.median(off) < 1.5 and off[40] < 30


def test_pick_ball_leaves_what_stands(spark):
    rows = [(1, f, 500.0 + 8 * f, 300.0) for f in range(60)] + [(1, f, 300.0, 60.0) for f in range(60)]
    got = {r.f: r.x for r in chains.pick_ball(spark.createDataFrame(rows, "m long, f long, x double, y double"), ["m"], "f").collect()}
    assert all(got[f] == 500.0 + 8 * f for f in range(60))


def test_anchors(spark):
    rng = np.random.default_rng(2)
    rows = [(float(w + rng.normal(0, 0.5)), float(h + rng.normal(0, 0.5))) for w, h in ((10, 13), (60, 45), (200, 150)) for _ in range(60)]
    got = chains.anchors(spark.createDataFrame(rows, "w double, h double"), 3)
    assert np.allclose([(r.w, r.h) for r in got.orderBy("anchor").collect()], [(10, 13), (60, 45), (200, 150)], atol=1.0)


def test_apart_and_merged():
    rng = np.random.default_rng(3)
    assert N.merged([(5, 40), (1, 4), (38, 90), (45, 92), (100, 120)]) == [(1, 4), (5, 40), (38, 92), (100, 120)]
    for _ in range(50):
        at = np.unique(rng.integers(0, 200, 30))
        high = rng.random(len(at))
        kept = set(N.apart(at, high, 7).tolist())
        for p, h in zip(at, high):  # a place goes only for a higher one near it that stays
            rivals = [q for q, g in zip(at, high) if q in kept and abs(q - p) < 7 and q != p and g > h]
            assert (p in kept) == (not rivals)


def _bouncing(rng):
    """A ball on straight lines between corners, seen with noise, not at all for a while, and twice where it isn't."""
    corners = [(0, 100.0, 100.0), (60, 520.0, 160.0), (130, 660.0, 600.0), (190, 200.0, 500.0), (260, 900.0, 300.0)]
    f = np.arange(261)
    x, y = (np.interp(f, [c[0] for c in corners], [c[k] for c in corners]) for k in (1, 2))
    rows = [("m", int(i), float(x[i] + rng.normal(0, 0.6)), float(y[i] + rng.normal(0, 0.6))) for i in f if not 90 <= i < 104]
    return f, x, y, rows


def test_ball_path_with_bounces_and_gaps(spark):
    f, x, y, rows = _bouncing(np.random.default_rng(4))
    rows[30] = ("m", rows[30][1], 900.0, 20.0)
    df = spark.createDataFrame(rows, "m string, f long, x double, y double")
    got = sorted(chains.ball_path(df.repartition(3), ["m"], "f").collect(), key=lambda r: r.f)
    assert [r.f for r in got] == f.tolist()
    off = np.hypot([r.x for r in got] - x, [r.y for r in got] - y)
    assert np.median(off) < 6 and off.max() < 30 and off[90:104].max() < 10  # turns are rounded where lines are pinned
    # the same, put together plainly: pins, and straight lines between them
    frames = np.array([r[1] for r in rows])
    path, acceleration = chains.settled(np.array([r[2] for r in rows]), np.array([r[3] for r in rows]))
    path = tracks.without_waves(path[:, 0], path[:, 1])
    pieces = [(a, b) for a, b, _ in tracks.straight_pieces(path[:, 0], path[:, 1])]
    pins = {0, len(frames) - 1} | {k for s in N.merged(pieces) for k in s}
    peaks = [k for k in N.peaks(acceleration, 10.0) if all(frames[k] >= frames[b] + 8 or frames[k] <= frames[a] - 8 for a, b in pieces)]
    assert not peaks  # here all turns are ends of pieces
    at = np.array(sorted(pins))
    for axis, name in ((0, "x"), (1, "y")):
        assert np.allclose([r[name] for r in got], np.interp(f, frames[at], path[at, axis]))
    assert len(pins) < 40
    assert chains.ball_path(df.limit(0), ["m"], "f").count() == 0
