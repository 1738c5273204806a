"""What overlapping() puts on disk on the way to its tiles (F1 of round 4)."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pathloom.operators import boxes


def _crowd(spark, n):
    """Random boxes of whole numbers, but for y2, as those of crowd_pairs are."""
    x, y, side = (F.floor(F.rand(k) * top).cast("double") for k, top in ((1, 15_000), (2, 1_500), (3, 50)))
    return spark.range(0, n, 1, 4).select((F.col("id") % 3).cast("string").alias("image"), F.col("id").alias("det"), x.alias("x1"), y.alias("y1"), (x + 1 + side).alias("x2"), (y + (1 + side) * 1.07).alias("y2"))


def _written(spark) -> int:
    """Bytes of shuffle that the session has written."""
    for _ in range(2):  # the store shows a task's bytes with a later event at the latest
        spark.range(1).count()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        time.sleep(0.3)
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def test_boxes_go_to_their_tiles_packed(spark):
    """Each box went as a row of its own, with its tile: 41 bytes of shuffle for each of these, now 19."""
    n = 400_000
    before = _written(spark)
    assert boxes.overlapping(_crowd(spark, n), ["image"], "det", 0.3, 60.0, 6).count() > 0
    assert 0 < _written(spark) - before < 28 * n


@pytest.mark.parametrize("part", [1, 3, 512])
@pytest.mark.parametrize("seed", range(6))
def test_packed_rows_hold_what_was_packed(seed, part):
    rng = np.random.default_rng(seed)
    n = [1, 2, 700, 700, 700, 700][seed]
    values = {
        "whole": np.floor(rng.uniform(-90, 90, n)),
        "part": rng.uniform(-1, 1, n),
        "wide": np.floor(rng.uniform(0, [300, 70_000, 1 << 33][seed % 3], n)),
        "huge": rng.choice([1e300, -1e300, 0.5, 2.0**53, -(2.0**53)], n),
        "id": rng.choice(np.array([-(1 << 63), (1 << 63) - 1, 5, 6, 7]), n) if seed % 2 else rng.integers(-5, 300, n),
    }
    keys = {"a": rng.choice(["p", "q", "r"], n), "b": rng.choice([-(1 << 62), 4, 1 << 62], n)}
    table = pa.table(keys | values)
    tables = [boxes.packed(t, ["a", "b"], list(values), part) for t in (table.slice(0, n // 2), table.slice(n // 2)) if len(t)]
    got = pa.concat_tables(tables)  # those of two tasks, which may take other widths
    count = got.column("_n").to_numpy()
    assert count.max() <= part and count.sum() == n
    back = [np.repeat(got.column(c).to_numpy(zero_copy_only=False), count) for c in keys] + [boxes.unpacked(got, c, count) for c in values]
    assert sorted(zip(*(v.tolist() for v in back))) == sorted(zip(*(v.tolist() for v in (keys | values).values())))


@pytest.mark.parametrize(("pack", "part", "block", "run"), [(7, 512, 50_000, 20_000), (50, 3, 40, 64), (50, 1, 50_000, 10)])
def test_overlapping_equals_all_with_all_however_packed(spark, monkeypatch, pack, part, block, run):
    for name, value in {"PACK": pack, "PART": part, "BLOCK": block, "RUN_ROWS": run}.items():
        monkeypatch.setattr(boxes, name, value)
    rng = np.random.default_rng(pack)
    rows = []
    for i in range(300):
        x, y, w = rng.uniform(-90, 90, 3) if i < 100 else np.floor(rng.uniform(-90, 90, 3))  # some packs hold whole numbers alone
        rows.append((str(i % 2), 1000 - 7 * i if i % 50 else (1 << 40) + i, float(x), float(y), float(x + abs(w) / 2), float(y + abs(w) / 3)))
    df = spark.createDataFrame(rows, "image string, det long, x1 double, y1 double, x2 double, y2 double").repartition(3)
    read = lambda d: sorted((r.image, r.left_id, r.right_id, round(r.value, 12)) for r in d.collect())
    want = read(boxes.pairs(df, df, ["image"], "det", "det", least=0.1).filter("left_id < right_id"))
    assert read(boxes.overlapping(df, ["image"], "det", 0.1, 12.0)) == want and len(want) > 40


def test_empty_boxes_have_no_pairs(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 0.0, 0.0, 1.0)], "image string, det long, x1 double, y1 double, x2 double, y2 double")
    assert boxes.overlapping(df, ["image"], "det", 0.1, 12.0).collect() == []
