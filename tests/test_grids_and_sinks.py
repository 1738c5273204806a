"""Grids of boxes and points, curves, the ball's choice, masks, label files and streamed windows, against plain versions."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom import numerics as N
from pathloom.functions import geometry
from pathloom.operators import boxes, chains, evaluation, stats
from pathloom.sources import files, labelfiles
from pathloom.streaming import tracks as streaming

BOXES = "image string, det long, cls string, x1 double, y1 double, x2 double, y2 double, conf double"


def _boxes(rng, n, images=("a", "b", None), wide=60):
    out = []
    for i in range(n):
        x, y = rng.uniform(-300, 300), rng.uniform(-300, 300)
        w = 500 if i % 97 == 0 else rng.uniform(0, wide)
        out.append((rng.choice(images), i, rng.choice("kp"), x, y, x + w, y + rng.uniform(0, wide), round(rng.random(), 2)))
    return out


def test_boxes_meet_by_a_grid(spark):
    df = spark.createDataFrame(_boxes(random.Random(1), 500, ("a", "b")), BOXES)
    left, right = df.filter("det % 2 = 0"), df.filter("det % 2 = 1")
    for kind, least in (("iou", 0.01), ("ioa", 0.3)):
        read = lambda cell: sorted((r.image, r.left_id, r.right_id, round(r.value, 12)) for r in boxes.pairs(left, right, ["image"], "det", "det", kind, least, cell).collect())
        whole = read(None)
        assert len(whole) > 50 and read(40.0) == whole and read(1000.0) == whole
    ids = lambda d: sorted(r.det for r in d.collect())
    want = ids(boxes.without_enclosed(df, ["image"], "det", 0.7, 0.8))
    assert ids(boxes.without_enclosed(df, ["image"], "det", 0.7, 0.8, 50.0)) == want and len(want) < 500
    want = ids(boxes.uncovered(left, right, ["image"], "det", 0.2))
    assert ids(boxes.uncovered(left, right, ["image"], "det", 0.2, cell=50.0)) == want and 0 < len(want) < 250
    with pytest.raises(ValueError):
        boxes.pairs(left, right, ["image"], "det", "det", cell=9.0)


def test_a_frame_of_many_boxes(spark):
    """20 000 boxes of one frame: candidates stay near the number of boxes."""
    n = 20_000
    df = spark.range(n).select(F.lit("f").alias("image"), F.col("id").alias("det"), ((F.col("id") % 200) * 30.0).alias("x1"), (F.floor(F.col("id") / 200) * 30.0).alias("y1"))
    df = df.withColumn("x2", F.col("x1") + 35.0).withColumn("y2", F.col("y1") + 35.0)
    a = df.select("image", F.col("det").alias("_l"), *[F.col(c).alias(f"a_{c}") for c in boxes.BOX])
    b = df.select("image", F.col("det").alias("_r"), *[F.col(c).alias(f"b_{c}") for c in boxes.BOX])
    assert boxes._touching(a, b, ["image"], 36.0).count() < 10 * n
    assert boxes.pairs(df, df, ["image"], "det", "det", least=0.9, cell=36.0).count() == n


def _plain_nms(rows, iou, top, most, per_class):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = set()
    for image in by.values():
        kept = []
        for r in sorted(image, key=lambda r: (-r[7], r[3:7], r[2]))[:most]:
            def over(o):
                w, h = min(r[5], o[5]) - max(r[3], o[3]), min(r[6], o[6]) - max(r[4], o[4])
                both = max(w, 0) * max(h, 0)
                return both / ((r[5] - r[3]) * (r[6] - r[4]) + (o[5] - o[3]) * (o[6] - o[4]) - both + 1e-7)

            if not any((not per_class or o[2] == r[2]) and over(o) > iou for o in kept) and (top is None or len(kept) < top):
                kept.append(r)
        out |= {r[1] for r in kept}
    return out


@pytest.mark.parametrize("top,most,per_class", [(None, None, True), (7, 100, True), (None, 50, False)])
def test_suppression_streams_images(spark, top, most, per_class):
    rows = _boxes(random.Random(2), 900, ("a", "b", "c", None), 150)
    was, boxes.RUN_ROWS = boxes.RUN_ROWS, 64
    try:
        got = boxes.suppress(spark.createDataFrame(rows, BOXES).repartition(3), "image", 0.0, 0.3, top, most, per_class).collect()
    finally:
        boxes.RUN_ROWS = was
    assert {r.det for r in got} == _plain_nms(rows, 0.3, top, most, per_class) and len(got) == len({r.det for r in got})


def _plain_dbscan(p, eps, least):
    near = ((p[:, None] - p[None]) ** 2).sum(-1) <= eps * eps
    core, labels, k = near.sum(1) >= least, np.full(len(p), -1), 0
    for i in range(len(p)):
        if core[i] and labels[i] < 0:
            labels[i], stack = k, [i]
            while stack:
                q = stack.pop()
                if core[q]:
                    new = np.flatnonzero(near[q] & (labels < 0))
                    labels[new] = k
                    stack += new.tolist()
            k += 1
    return labels


def test_density_clusters_by_cells():
    rng = np.random.default_rng(3)
    for k in range(150):
        n = int(rng.integers(0, 90))
        p = rng.uniform(0, 30, (n, 2)) if k % 3 else np.round(rng.uniform(0, 12, (n, 2)))  # the latter with ties and repeats
        eps, least = float(rng.uniform(0.5, 5)), int(rng.integers(1, 7))
        assert N.dbscan(p, eps, least).tolist() == _plain_dbscan(p, eps, least).tolist()
    crowd = np.concatenate([np.zeros((60_000, 2)), rng.uniform(0, 1000, (20_000, 2))])
    assert N.dbscan(crowd, 2.0, 5)[:60_000].max() == 0  # an n by n table would take 50 GB


def test_curves_of_a_hot_class(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 9 + ["b"]), i, round(rng.random(), 2), int(rng.random() < 0.4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "cls string, id long, score double, hit int").repartition(5)
    positives = df.groupBy("cls").agg(F.sum("hit").alias("positives"))
    got = defaultdict(dict)
    for r in stats.precision_recall(df, "cls", "score", "hit", positives).collect():
        got[r.cls][r["rank"]] = (r.tp, r.fp)
    for c in ("hot", "b"):
        tp = 0
        for k, (_, _, _, hit) in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: (-r[2], r[1])), 1):
            tp += hit
            assert got[c][k] == (tp, k - tp)


def _plain_choice(rows, jump=150.0, still=5.0, window=5):
    f = np.array([[1, 0, 1, 0], [0, 1, 0, 1], [0, 0, 1, 0], [0, 0, 0, 1]], float)
    h, x, p = np.eye(2, 4), None, np.eye(4) * 100
    frames, out, last = defaultdict(list), [], None
    for fr, a, b in rows:
        frames[fr].append((a, b))

    def update(z):
        nonlocal x, p
        s = h @ p @ h.T + np.eye(2) * 50
        k = p @ h.T @ np.linalg.inv(s)
        x, p = x + k @ (np.array(z) - h @ x), (np.eye(4) - k @ h) @ p

    for fr in sorted(frames):
        here = sorted(frames[fr])
        if x is None:
            z = min(here, key=lambda c: np.hypot(c[0] - 530, c[1] - 330))
            x = np.array([*z, 0, 0], float)
        elif len(here) == 1:
            z = here[0]
            if np.hypot(z[0] - last[0], z[1] - last[1]) > jump:
                continue
            x, p = f @ x, f @ p @ f.T + np.eye(4) * 10
            update(z)
        else:
            x, p = f @ x, f @ p @ f.T + np.eye(4) * 10

            def cost(c):
                stood = sum(np.hypot(c[0] - o[0], c[1] - o[1]) < still for g in range(fr - window, fr) for o in frames.get(g, ()))
                moved = np.hypot(c[0] - last[0], c[1] - last[1])
                return np.hypot(c[0] - x[0], c[1] - x[1]) + 50 * stood + (1000 if moved > jump else moved)

            z = min(here, key=cost)
            update(z)
        last = z
        out.append((fr, *z))
    return out


def test_ball_choice_by_a_plain_filter(spark):
    rng, rows = random.Random(5), []
    x, y, vx, vy = 500.0, 300.0, 9.0, 4.0
    for f in range(400):
        if rng.random() < 0.03:
            vx, vy = rng.uniform(-20, 20), rng.uniform(-20, 20)
        x, y = x + vx, y + vy
        if rng.random() < 0.85:
            rows.append((f, x + rng.gauss(0, 2), y + rng.gauss(0, 2)))
        rows += [(f, rng.uniform(0, 1060), rng.uniform(0, 660)) for _ in range(rng.choice([0, 0, 1, 2]))]
        if 100 < f < 300:
            rows.append((f, 200.0, 200.0))
    df = spark.createDataFrame([("m", *r) for r in rows], "m string, f long, x double, y double")
    assert sorted((r.f, r.x, r.y) for r in chains.pick_ball(df.repartition(4), ["m"], "f").collect()) == _plain_choice(rows)


def test_packed_masks(spark):
    rng = random.Random(6)
    rows = []
    for i, n in enumerate((1, 63, 64, 65, 200, 640)):
        rows.append((i, [rng.randrange(2) for _ in range(n)], [rng.randrange(2) for _ in range(n)]))
    rows += [(10, [0] * 70, [0] * 70), (11, [], []), (12, [1], [1] * 65)]
    df = spark.createDataFrame(rows, "i int, a array<int>, b array<int>").withColumn("v", geometry.packed_iou(geometry.packed_mask(F.col("a")), geometry.packed_mask(F.col("b"))))
    got = {r.i: r.v for r in df.collect()}
    for i, a, b in rows[:6]:
        either = sum(x | y for x, y in zip(a, b))
        assert got[i] == pytest.approx(sum(x & y for x, y in zip(a, b)) / either if either else 0.0)
    assert (got[10], got[11], got[12]) == (0.0, 0.0, None)


def test_box_and_mask_bundle(spark):
    rows = [(c, lv, 0.99 - 0.01 * i, i, (i % 3 > 0) if lv < 0.7 else i % 2 > 0) for c in ("x", "y") for lv in (0.5, 0.75) for i in range(20)]
    df = spark.createDataFrame(rows, "cls string, level double, conf double, id long, hit boolean")
    positives = spark.createDataFrame([("x", 20), ("y", 20)], "cls string, positives long")
    got = {r.cls: r for r in evaluation.box_and_mask_bundle(df, df.filter("level < 0.7"), "cls", "level", positives).collect()}
    one = {r.cls: r for r in evaluation.metric_bundle(df, "cls", "level", positives).collect()}
    assert got.keys() == one.keys() == {"x", "y", None}
    for c, r in got.items():
        assert (r.box_ap, r.box_ap50) == (pytest.approx(one[c].ap), pytest.approx(one[c].ap50)) and r.mask_ap == pytest.approx(r.mask_ap50)
        assert r.fitness == pytest.approx(0.1 * (r.box_ap50 + r.mask_ap50) + 0.9 * (r.box_ap + r.mask_ap))


def test_label_files_read_back(spark, tmp_path):
    rows = [(f"dir/img {i}", i % 4, 0.5, 0.25, 0.1, 0.2 + i / 1000, 0.9) for i in range(40) for _ in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "image string, cls int, cx double, cy double, w double, h double, conf double").repartition(6)
    to = str(tmp_path / "labels")
    labelfiles.write_label_files(df, to, conf=False)
    back = files.read_labels(spark, f"{to}/part-*")
    assert back.filter("NOT valid").count() == 0 and back.select("file").distinct().count() == 40
    assert json.loads((tmp_path / "labels" / "_SUCCESS").read_text()) == {"files": 40, "lines": len(rows)}
    assert not list((tmp_path / "labels").glob("_staging*"))
    labelfiles.write_label_files(df.filter("cls = 1"), to, conf=False, mode="overwrite")
    assert files.read_labels(spark, f"{to}/part-*").select("file").distinct().count() == 10


def test_a_repeated_attempt_leaves_nothing_twice(tmp_path, monkeypatch):
    class Context:
        def partitionId(self):
            return 3

    monkeypatch.setattr(labelfiles.TaskContext, "get", staticmethod(lambda: Context()))
    writer = labelfiles._Writer(str(tmp_path), False)
    rows = [("a", "1 1"), ("a", "1 2"), ("b", "2 2")]
    lost, counts = writer.write(iter(rows)), writer.write(iter(rows))
    with pytest.raises(RuntimeError):
        writer.write(x if x else (_ for _ in ()).throw(RuntimeError()) for x in [rows[0], None])
    writer.commit([counts])
    assert lost.folder != counts.folder and sorted(p.name for p in tmp_path.rglob("*.txt")) == ["a.txt", "b.txt"]
    assert not list(tmp_path.glob("_staging*"))
    other = labelfiles._Writer(str(tmp_path), False)
    other.abort([other.write(iter(rows))])
    assert len(list(tmp_path.rglob("*.txt"))) == 2


def test_histograms_of_archives(spark, tmp_path):
    np.save(tmp_path / "home_1.npy", np.array([1.0, 3.0]))
    np.savez(tmp_path / "away_1.npz", other=np.array([9.0]), hist=np.array([[2.0, 2.0]]))
    np.savez(tmp_path / "away_2.npz", b=np.array([9.0, 1.0]), a=np.array([0.0, 0.0]))
    np.savez(tmp_path / "none.npz")
    got = {r.name: (r.team, r.histogram) for r in files.read_histograms(spark, str(tmp_path)).collect()}
    assert got == {"home_1.npy": ("home", [0.25, 0.75]), "away_1.npz": ("away", [0.5, 0.5]), "away_2.npz": ("away", [0.0, 0.0]), "none.npz": ("none", None)}


def test_streamed_windows_equal_the_table(spark, tmp_path):
    rng, base = random.Random(7), datetime(2024, 5, 1)
    rows = [(rng.randrange(4), base + timedelta(seconds=rng.randrange(20_000))) for _ in range(500)] + [(9, base + timedelta(days=2))]
    df = spark.createDataFrame(rows, "user long, ts timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    for k, slide in enumerate((None, "10 minutes")):
        batch = sorted((r.user, r.start, r.n) for r in streaming.windows(df, "user", slide=slide).collect() if r.user < 9)
        live = streaming.drain(streaming.windows(streaming.stream(spark, str(tmp_path / "in"), df.schema), "user", slide=slide), f"live_windows{k}", str(tmp_path / f"cp{k}"))
        assert sorted((r.user, r.start, r.n) for r in live.collect() if r.user < 9) == batch and batch


def test_precision_envelope_of_many_chunks(spark, monkeypatch):
    from pathloom.operators import tall

    rng = random.Random(8)
    rows = [(c, i, round(rng.random(), 3), int(rng.random() < 0.3)) for c in "ab" for i in range(400)]
    df = spark.createDataFrame(rows, "cls string, id long, score double, hit int")
    curve = stats.precision_recall(df, "cls", "score", "hit", df.groupBy("cls").agg(F.sum("hit").alias("positives")))
    whole = {r.cls: r.ap for r in stats.average_precision(curve, "cls").collect()}
    monkeypatch.setattr(tall, "CHUNK", 37)
    monkeypatch.setattr(tall.running, "__defaults__", (37, False))
    monkeypatch.setattr(tall.previous, "__defaults__", (37, False))
    assert {r.cls: r.ap for r in stats.average_precision(curve, "cls").collect()} == pytest.approx(whole)
