"""Overlapping boxes of crowded planes (F14)."""

import random
import time

import numpy as np
import pytest

from pathloom.operators import boxes

KINDS = "image string, kind long, det long, x1 double, y1 double, x2 double, y2 double"


def _plain(x1, y1, x2, y2, group, cx, cy, side, least):
    out = []
    for i in range(len(x1)):
        j = np.arange(i + 1, len(x1))
        both = np.clip(np.minimum(x2[i], x2[j]) - np.maximum(x1[i], x1[j]), 0, None) * np.clip(np.minimum(y2[i], y2[j]) - np.maximum(y1[i], y1[j]), 0, None)
        value = both / ((x2[i] - x1[i]) * (y2[i] - y1[i]) + (x2[j] - x1[j]) * (y2[j] - y1[j]) - both + 1e-7)
        own = (np.floor(np.maximum(x1[i], x1[j]) / side) == cx[i]) & (np.floor(np.maximum(y1[i], y1[j]) / side) == cy[i])
        out += [(i, int(k)) for k in j[(value >= least) & (group[i] == group[j]) & own]]
    return out


@pytest.mark.parametrize("seed", range(18))
def test_near_finds_each_pair_once(monkeypatch, seed):
    if seed % 2:
        monkeypatch.setattr(boxes, "SLICE", 50)
        monkeypatch.setattr(boxes, "CHUNK", 100)
    rng = np.random.default_rng(seed)
    n, side, least = 500, [240.0, 7.0, 1e-3][seed % 3], [0.3, 0.05, 0.9, 0.01, 1.0, 0.5][seed % 6]
    wide = side * [1e-4, 0.05, 0.4, 3.0][seed % 4]
    group = np.sort(rng.integers(1, 4, n))
    cx, cy = group * 3 - 6, group - 2
    x1, y1 = (c * side + rng.uniform(-0.4, 1, n) * min(side, 4 * wide) for c in (cx, cy))
    w = wide * np.exp(rng.normal(0, [0.3, 1.0, 2.0][seed // 3 % 3], n))
    h = w * np.exp(rng.normal(0, [0.0, 0.5, 2.0][seed // 6 % 3], n))
    if seed % 5 == 0:  # ties
        x1, y1, w, h = (np.ceil(v / wide * 4) * wide / 4 for v in (x1, y1, w, h))
    x1, y1, w, h = (np.r_[v, v[:20]] for v in (x1, y1, w, h))  # copies, in the group of their own
    group, cx, cy = (np.r_[v, v[:20]] for v in (group, cx, cy))
    b = (x1, y1, x1 + w, y1 + h, group, cx, cy, side, least)
    got = [(min(p), max(p)) for rows, others, _ in boxes.near(*b) for p in zip(rows.tolist(), others.tolist())]
    assert sorted(got) == _plain(*b)


def test_a_crowded_plane_is_searched_near_its_pairs():
    """The cells that boxes of any size shared held 79 candidates for each pair that was found, over 6 x sf0.1."""
    rng = np.random.default_rng(3)
    n = 24_000
    x, y, side = np.floor(rng.uniform(0, 720, n)), np.floor(rng.uniform(0, 100, n)), rng.integers(1, 51, n)
    tile = (x // 240).astype(int)
    began = time.perf_counter()
    found = sum(len(a) for a, _, _ in boxes.near(x, y, x + side, y + side, tile, tile, np.zeros(n, int), 240.0, 0.3))
    assert found > 700_000 and time.perf_counter() - began < 3


@pytest.mark.parametrize(("block", "run"), [(50_000, 20_000), (40, 20_000), (40, 64), (1, 10)])
def test_overlapping_equals_all_with_all(spark, monkeypatch, block, run):
    monkeypatch.setattr(boxes, "BLOCK", block)
    monkeypatch.setattr(boxes, "RUN_ROWS", run)
    rng = random.Random(block)
    rows = []
    for i in range(40 if block == 1 else 400):
        x, y = (round(rng.uniform(-90, 90)) * 1.0 for _ in "xy")
        w = 300.0 if i % 97 == 0 else round(rng.uniform(0, 40)) * 1.0
        rows.append((rng.choice(["a", "b", None]), rng.choice([1, 2]), 1000 - i, x, y, x + w, y + (w if i % 2 else rng.uniform(0, 40))))
    rows += [("a", 1, 2000 + i, 5.0, 5.0, 25.0, 25.0) for i in range(9)] + [("a", 1, 2000, 6.0, 5.0, 26.0, 25.0)]  # copies, and an id that comes twice
    rows += [("a", 1, 3000, None, 5.0, 25.0, 25.0), ("a", 1, 3001, float("nan"), 5.0, 25.0, 25.0), ("a", 1, None, 5.0, 5.0, 25.0, 25.0), ("a", 1, 3002, 25.0, 5.0, 5.0, 25.0)]
    df = spark.createDataFrame(rows, KINDS)
    whole = boxes.pairs(df.filter("x1 is not null and not isnan(x1)"), df, ["image", "kind"], "det", "det", least=0.1).filter("left_id < right_id and not isnan(value)")
    read = lambda d: sorted((r.image, r.kind, r.left_id, r.right_id, round(r.value, 12)) for r in d.collect())
    want = read(whole)
    assert read(boxes.overlapping(df, ["image", "kind"], "det", 0.1, 12.0)) == want and len(want) > 40
    assert {(r.left_id, r.right_id, r.value) for r in boxes.overlapping(df, ["image", "kind"], "det", 0.1, 500.0, 2).collect()} == {(r[2], r[3], float(np.floor(r[4] * 100 + 0.5) / 100)) for r in want}
    with pytest.raises(ValueError):
        boxes.overlapping(df, ["image"], "det", 0.0, 12.0)
