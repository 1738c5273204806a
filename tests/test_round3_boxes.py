"""Boxes of many images are looked at together (F19, F21)."""

import time

import numpy as np
import pytest

from pathloom.operators import boxes


def _plain(b, cls, start, n, iou, top):
    kept = []
    for i in range(start, start + n):
        def over(k):
            w, h = min(b[i, 2], b[k, 2]) - max(b[i, 0], b[k, 0]), min(b[i, 3], b[k, 3]) - max(b[i, 1], b[k, 1])
            both = max(w, 0) * max(h, 0)
            size = lambda j: (b[j, 2] - b[j, 0]) * (b[j, 3] - b[j, 1])
            return both / (size(k) + size(i) - both + 1e-7) > iou and cls[i] == cls[k]

        if not any(map(over, kept)):
            kept.append(i)
        if len(kept) == top:
            break
    return kept


@pytest.mark.parametrize(("top", "alone"), [(None, 512), (3, 512), (None, 20), (1, 5)])
def test_turns_keep_what_one_image_at_a_time_keeps(monkeypatch, top, alone):
    monkeypatch.setattr(boxes, "ALONE", alone)
    rng = np.random.default_rng(4)
    sizes = np.r_[rng.integers(0, 40, 60), 0, 1, 150]
    edges = np.r_[0, np.cumsum(sizes)]
    low = rng.integers(0, 60, (edges[-1], 2)).astype(float)
    b, cls = np.hstack([low, low + rng.integers(0, 50, low.shape)]), rng.integers(-1, 2, len(low))
    n = np.minimum(sizes, 30)  # the best 30 alone
    want = [k for s, m in zip(edges[:-1], n) for k in _plain(b, cls, s, m, 0.3, top)]
    assert boxes.kept_boxes(b, cls, edges[:-1], n, 0.3, top).tolist() == want


def test_many_small_images_take_a_few_turns():
    rng = np.random.default_rng(5)
    low = rng.uniform(0, 90, (200_000, 2))
    b = np.hstack([low, low + rng.uniform(1, 50, low.shape)])
    began = time.perf_counter()
    got = boxes.kept_boxes(b, np.zeros(len(b), int), np.arange(0, len(b), 5), np.full(len(b) // 5, 5), 0.3, 300)
    assert time.perf_counter() - began < 2  # box by box it was more than 5
    assert 40_000 < len(got) < 200_000
