"""Operators whose groups are cut for many tasks, against the same work in one."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pathloom.operators import tracker, tracks


def _pieces(rng, n, teams=("h", None)):
    rows = []
    for i in range(n):
        start = rng.randrange(0, 40 * n // 10)
        end = start + rng.randrange(0, 60)
        x, y = rng.uniform(0, 400), rng.uniform(0, 300)
        rows.append((rng.choice(teams), i, start, end, x, y, x + rng.uniform(-60, 60), y + rng.uniform(-60, 60)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_stitching_by_what_can_meet(spark, seed):
    df = spark.createDataFrame(_pieces(random.Random(seed), 600), "team string, piece long, start long, end long, x0 double, y0 double, x1 double, y1 double")
    at = lambda d: sorted((r.piece, r.track) for r in d.collect())
    whole = at(tracks.stitch(df, ["team"]))
    assert at(tracks.stitch(df, ["team"], alone=0)) == whole
    assert sum(p != t for p, t in whole) > 50


def _crowd(seed, people=14, frames=900):
    """Walkers who bounce within a pitch, are missed now and then, and leave for good sometimes."""
    rng = np.random.default_rng(seed)
    rows = []
    for person in range(people):
        at, v = rng.uniform(0, 900, 2), rng.uniform(-4, 4, 2)
        hidden, born, dies = 0, int(rng.integers(0, frames // 3)), int(rng.integers(frames // 2, frames + 200))
        for f in range(born, min(frames, dies)):
            v = np.clip(v + rng.normal(0, 0.3, 2), -5, 5)
            at = at + v
            v = np.where((at < 0) | (at > 900), -v, v)
            if hidden:
                hidden -= 1
                continue
            if rng.random() < 0.01:
                hidden = int(rng.integers(1, 25))
            rows.append(("m", f, float(at[0]), float(at[1]), float(at[0] + 30), float(at[1] + 70), float(rng.uniform(0.4, 0.95)), person))
    return rows


def test_tracking_in_chunks_keeps_identities(spark):
    """Against the tracker that runs in order: at most one box in a hundred is in another track."""
    df = spark.createDataFrame(_crowd(3), "file string, frame long, x1 double, y1 double, x2 double, y2 double, conf double, person int")
    one = {(r.frame, r.person): r.track for r in tracker.track(df, ["file"]).collect()}
    got = tracker.track(df.repartition(5), ["file"], chunk=200).collect()
    many = {(r.frame, r.person): r.track for r in got}
    assert many.keys() == one.keys() and len(got) == df.count()
    pairs = defaultdict(Counter)
    for k, t in one.items():
        pairs[t][many[k]] += 1
    agree = sum(c.most_common(1)[0][1] for c in pairs.values())
    assert agree >= 0.99 * len(one), agree / len(one)
    assert {t for t in many.values() if t is not None} == set(range(1, 1 + max(t for t in many.values() if t is not None)))
    # identities that change from one box of a person to the next: no more than in order, but for one a seam
    def switches(m):
        runs = [[m[k] for k in sorted(m) if k[1] == p and m[k] is not None] for p in range(14)]
        return sum(a != b for s in runs for a, b in zip(s, s[1:]))

    assert switches(many) <= switches(one) + 4


def test_chunks_of_several_groups(spark):
    rows = [(file, f, 10.0 + 2 * f, y, 50.0 + 2 * f, y + 60, 0.9) for file in ("a", "b", None) for y in (0.0, 200.0) for f in range(260)]
    df = spark.createDataFrame(rows, "file string, frame long, x1 double, y1 double, x2 double, y2 double, conf double")
    got = defaultdict(set)
    for r in tracker.track(df, ["file"], chunk=121).collect():
        got[r.file, r.y1].add(r.track)
    assert all(len(v) == 1 for v in got.values()) and all({*got[f, 0.0], *got[f, 200.0]} == {1, 2} for f in ("a", "b", None))
