"""Boosted trees and isotonic calibration against plain versions."""

import numpy as np
import pytest

from pathloom.llm.trees import BoostedTrees, DecisionTree, Isotonic


def _loss(margin, y):
    p = 1 / (1 + np.exp(-margin))
    return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()


@pytest.mark.parametrize("seed", range(8))
def test_first_split_is_the_best_of_all(seed):
    """One tree of depth 1: the split of greatest gain over all features and values, and Newton steps as leaves."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(40, 3)), 1)
    y = (x[:, seed % 3] + rng.normal(0, 0.7, 40) > 0).astype(float)
    model = BoostedTrees(x, y, trees=1, depth=1, rate=0.3, bins=400, l2=1.5, least=0.0)
    base = np.log((y.sum() + 0.5) / (40 - y.sum() + 0.5))
    p = 1 / (1 + np.exp(-base))
    g, h = y - p, np.full(40, p * (1 - p))
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.5)
    best = max(score(x[:, f] <= c) + score(x[:, f] > c) for f in range(3) for c in np.unique(x[:, f])[:-1])
    feature, cut, value = model.forest[0]
    left = x[:, feature[0]] <= cut[0]
    assert score(left) + score(~left) == pytest.approx(best)
    leaf = np.where(left, g[left].sum() / (h[left].sum() + 1.5), g[~left].sum() / (h[~left].sum() + 1.5))
    assert np.allclose(model.margins(x), base + 0.3 * leaf)


def test_loss_falls_and_held_out_rows_are_found():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1.2)).astype(float)  # no single feature tells
    losses = [_loss(BoostedTrees(x[:400], y[:400], trees=t).margins(x[:400]), y[:400]) for t in (1, 10, 40, 120)]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    model = BoostedTrees(x[:400], y[:400])
    assert ((model.margins(x[400:]) > 0) == (y[400:] > 0)).mean() > 0.85
    assert np.isfinite(BoostedTrees(x[:5], np.zeros(5)).margins(x)).all()


@pytest.mark.parametrize("seed", range(8))
def test_isotonic_pools(seed):
    """Pool means are those of the max-min formula of isotonic regression."""
    rng = np.random.default_rng(seed)
    margin = rng.permutation(60) / 10.0
    y = (margin + rng.normal(0, 2, 60) > 3).astype(float)
    order = np.argsort(margin)
    m, t = margin[order], y[order]
    mean = lambda a, b: t[a : b + 1].mean()
    fit = np.array([max(min(mean(a, b) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)])
    pools = np.split(np.arange(60), np.flatnonzero(np.diff(fit) > 1e-12) + 1)
    iso = Isotonic(margin, y)
    assert np.allclose(iso.at, [m[p].mean() for p in pools])
    assert np.allclose(iso.value, np.maximum.accumulate([(t[p].sum() + 0.25) / (len(p) + 0.5) for p in pools]))
    read = iso(np.linspace(-5, 12, 200))
    assert (np.diff(read) >= 0).all() and read.min() >= 0 and read.max() <= 1


def test_decision_tree_splits_what_can_be_split():
    rng = np.random.default_rng(10)
    x = rng.integers(0, 4, (80, 3)).astype(float)
    y = ((x[:, 0] > 1) & (x[:, 1] < 2)).astype(float)
    tree = DecisionTree(x, y)
    assert all((tree(r) > 0.5) == (t > 0.5) for r, t in zip(x, y))
