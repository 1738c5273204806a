"""Curves are summed up beside what is read of them (F8, F16, F17)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom import storage
from pathloom.operators import evaluation, numbering, stats


def _scored(spark, n=3000, positives=100, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in ("x", "y", "z"):
        hits = set(rng.sample(range(n), positives if c != "z" else positives // 3))
        rows += [(c, lv, round(rng.random() ** (0.3 if i in hits else 2), 2), i, i in hits and (lv < 0.7 or i % 2 == 0)) for lv in (0.5, 0.75) for i in range(n)]
    return rows, spark.createDataFrame(rows, "cls string, level double, conf double, id long, hit boolean").repartition(5), spark.createDataFrame([(c, positives) for c in "xyz"], "cls string, positives long")


def _plain(rows, positives):
    """Rows (conf, id, hit) -> ap, and (recall, precision) at 1000 confidences."""
    rows = sorted(rows, key=lambda r: (-r[0], r[1]))
    tp = np.cumsum([r[2] for r in rows])
    recall, precision, conf = tp / (positives + 1e-16), tp / np.arange(1, len(tp) + 1), np.array([r[0] for r in rows])
    r, p = np.r_[0.0, recall, 1.0], np.r_[1.0, precision, 0.0]
    env = np.maximum.accumulate(p[::-1])[::-1]
    at = np.linspace(0, 1, 101)
    ap = 0.0
    for i, x in enumerate(at):
        x = i / 100.0
        for k in range(len(r) - 1):
            if r[k + 1] > r[k] and r[k] <= x and (x < r[k + 1] or (x == 1 and r[k + 1] >= 1)):
                ap += (env[k] + (env[k + 1] - env[k]) * (x - r[k]) / (r[k + 1] - r[k])) * (0.005 if x in (0.0, 1.0) else 0.01)
    return ap, conf, recall, precision


def test_average_precision_keeps_few_rows(spark):
    rows, df, positives = _scored(spark)
    curve = evaluation.curves(df, ["cls", "level"], positives)
    got = evaluation.average_precisions(curve, ["cls", "level"])
    assert spark.read.parquet(storage._paths[-1]).count() <= 6 * 103 < curve.count()
    got = {(r.cls, r.level): r.ap for r in got.collect()}
    assert got == {(c, lv): pytest.approx(_plain([r[2:] for r in rows if r[:2] == (c, lv)], 100)[0], abs=1e-9) for c in "xyz" for lv in (0.5, 0.75)}


def test_metric_bundle_holds_no_curve_in_a_task(spark):
    rows, df, positives = _scored(spark, 1500, 60, 2)
    before = len(storage._paths)
    bundle = evaluation.metric_bundle(df, "cls", "level", positives)
    assert "windowspecdefinition(1" not in bundle._jdf.queryExecution().analyzed().toString()
    steps = [p for p in storage._paths[before:] if "/curve-steps-" in p]
    assert steps and spark.read.parquet(steps[0]).count() <= 3 * 102 < 3 * 1500
    got = {r.cls: r for r in bundle.collect()}
    curves = {c: _plain([r[2:] for r in rows if r[:2] == (c, 0.5)], 60) for c in "xyz"}
    assert {c: got[c].ap50 for c in curves} == {c: pytest.approx(v[0], abs=1e-9) for c, v in curves.items()}
    # the working point, read by straight lines from the last row of each confidence to the first of the next
    i = 0
    for c, (_, conf, recall, precision) in curves.items():
        for k in range(1000):
            x = k / 999.0
            at = np.flatnonzero(conf >= x)
            if len(at) == 0 or at[-1] + 1 == len(conf):
                continue
            a, b = at[-1], at[-1] + 1
            r = recall[a] + (recall[b] - recall[a]) * (conf[a] - x) / (conf[a] - conf[b])
            p = precision[a] + (precision[b] - precision[a]) * (conf[a] - x) / (conf[a] - conf[b])
            i += abs(r - got[c].recall) < 1e-12 and abs(p - got[c].precision) < 1e-12
    assert i >= 3


def test_numbered_adds_totals(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), i, rng.choice([0, 1, 5, None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, i long, v long").repartition(7)
    got = {r.i: (r.p, r.t) for r in numbering.numbered(df, ["g"], [F.desc("o"), "i"], "p", ("v", "t")).collect()}
    for g in ("a", "b", None):
        total = 0
        for p, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))):
            total += r[3] or 0
            assert got[r[2]] == (p, total)
    assert len(got) == 2000


def test_a_class_without_hits(spark):
    df = spark.createDataFrame([("x", 0.5, 1, False), ("x", 0.4, 2, False)], "cls string, score double, id long, hit boolean")
    curve = stats.precision_recall(df, "cls", "score", "hit", spark.createDataFrame([("x", 4)], "cls string, positives long"))
    assert stats.average_precision(curve, "cls").first().ap < 0.51
