"""A chunk of frames streams through the tracker (F18)."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from pathloom.operators import tracker


def _boxes(rng, n):
    low = rng.uniform(0, 300, (n, 2))
    return np.hstack([low, low + rng.uniform(20, 60, low.shape)])


@pytest.mark.parametrize(("n", "m"), [(40, 60), (60, 40), (30, 30), (1, 5), (5, 0)])
@pytest.mark.parametrize("dense", [10**6, 0])
def test_pairs_without_a_matrix(monkeypatch, n, m, dense):
    monkeypatch.setattr(tracker, "DENSE", dense)
    rng = np.random.default_rng(n)
    a, b = _boxes(rng, n), _boxes(rng, m)
    cost = 1 - tracker.overlaps(a, b)
    want = [(r, c) for r, c in tracker.assignment(np.minimum(cost, 0.801)) if cost[r, c] <= 0.8]
    assert tracker.close_pairs(a, b, 0.8) == want


def test_a_crowded_frame_needs_no_memory_of_its_square():
    boxes = np.stack([np.arange(2500.0) * 100, np.zeros(2500), np.arange(2500.0) * 100 + 50, np.full(2500, 50.0)], 1)
    t = tracker.Tracker()
    t.update(0, boxes, np.full(2500, 0.9))
    tracemalloc.start()
    assert (t.update(1, boxes + 1, np.full(2500, 0.9)) == np.arange(1, 2501)).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6, peak  # a matrix of their pairs is 50 MB


def test_streamed_chunks_equal_whole_ones(spark):
    """Rows come in batches that cut frames and groups; a chunk without rows of its own gives nothing."""
    rng = np.random.default_rng(8)
    rows = []
    for g in ("a", "b", None):
        for chunk in (0, 1):
            for f in range(40 * (g != "b"), 60):
                for i in range(9):
                    x, y = 40.0 * i + f + rng.uniform(-1, 1), 3.0 * i
                    rows.append((g, chunk, 1 if g == "b" else chunk, f, x, y, x + 30, y + 60, float(rng.uniform(0.05, 0.95)), len(rows)))
    names = ["g", "_chunk", "_home", "frame", *tracker.BOX, "conf", "_row"]
    whole = {}
    for (g, chunk), part in pd.DataFrame(rows, columns=names).groupby(["g", "_chunk"], dropna=False):
        if (part["_chunk"] == part["_home"]).any():
            done = tracker._tracked(part, "frame", "conf", tracker.Association())
            whole |= {r: t for r, t in zip(done["_row"], done["track"]) if not pd.isna(t)}
    df = spark.createDataFrame(rows, "g string, _chunk long, _home long, frame long, x1 double, y1 double, x2 double, y2 double, conf double, _row long")
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    for size in (7, 100, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            cut = df.repartition(2, "g", "_chunk").sortWithinPartitions("g", "_chunk", "frame", F.desc("conf"), *tracker.BOX)
            got = cut.mapInArrow(tracker._streamed(["g", "_chunk"], "frame", "conf", tracker.Association(), "_home"), T.StructType([*df.schema.fields, T.StructField("track", T.LongType())]))
            assert {r._row: r.track for r in got.collect()} == whole and len(whole) > 500
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
