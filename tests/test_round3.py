"""Tests of the findings of round 3: crowded frames, ties, long groups."""

import random

import numpy as np

from pathloom.operators import roster, tracker, tracks


def test_rows_at_one_place_tie_by_the_columns_named(spark):
    rows = [(e, "h", f, float(e % 3), 0.0) for f in range(40) for e in range(f * 30, f * 30 + 30)]
    df = spark.createDataFrame(rows, "id long, team string, frame long, x double, y double")
    got = {r.frame: r.id for r in tracker.nearest_to_recent(df.orderBy("y", "frame", "x", -df.id).repartition(3), ["team"], "frame", then=("id",)).collect()}
    assert got == {f: f * 30 + 1 for f in range(40)}  # x = 1 is the centre


def test_numbers_in_a_crowd_of_one_component(spark):
    """2500 tracks that all meet: in order of confidence, each the first option that is free in all of its frames."""
    rng, rows = random.Random(5), []
    for t in range(2500):
        conf = rng.random()
        rows += [(f, "h", t, t % 3 + 1, conf) for f in rng.sample(range(40), 3)]
    df = spark.createDataFrame(rows, "frame long, team string, track long, number int, conf double")
    numbers = [1, 2, 3, 10, 11, 12, 20, 21, 30, 31, 13]
    got = {}
    for r in roster.resolve_in_frames(df, spark.createDataFrame([("h", numbers)], "team string, numbers array<int>")).collect():
        got.setdefault(r.track, set()).add((r.number, r.state))
    frames, conf, worn, best = {}, {}, {}, {}
    for f, _, t, n, c in rows:
        frames.setdefault(t, set()).add(f)
        conf[t] = c
        worn.setdefault((f, n), set()).add(t)
        best[f, n] = min(best.get((f, n), (-c, t)), (-c, t))
    want, taken = {}, {}
    loser = {t for t in frames if any(best[f, t % 3 + 1][1] != t for f in frames[t])}
    for t in sorted(frames, key=lambda t: (-conf[t], t)):
        n = t % 3 + 1
        if t not in loser:
            want[t] = {(n, "kept")}
            continue
        options = [o for o in numbers if str(n) in str(o) and o != n and not any(worn.get((f, o), set()) - {t} for f in frames[t])]
        o = next((o for o in options if not any(o in taken.get(f, ()) for f in frames[t])), None)
        for f in frames[t] if o else ():
            taken.setdefault(f, set()).add(o)
        want[t] = {(o, "changed" if o else "unsure")}
    assert got == want and sum(s == "changed" for v in want.values() for _, s in v) > 20


def _stitched(rows, most_gap=20, most_overlap=15, reach=50.0):
    active, out = [], {}
    for team, p, s, e, x0, y0, x1, y1 in sorted(rows, key=lambda r: (r[2], r[1])):
        active = [t for t in active if t[1] >= s - most_gap]
        near = [(float(np.hypot(t[2] - x0, t[3] - y0)), k) for k, t in enumerate(active) if -most_overlap <= s - t[1] <= most_gap]
        d, k = min(near, default=(np.inf, -1))
        if d <= reach:
            active[k] = (active[k][0], max(active[k][1], e), x1, y1)
            out[p] = active[k][0]
        else:
            active.append((p, e, x1, y1))
            out[p] = p
    return out


def test_stitching_a_crowd_makes_no_pairs(spark):
    """Pieces that nearly all can meet, many at one place: as in order, and in the plan no join."""
    rng, rows = random.Random(8), []
    for i in range(3000):
        s = rng.randrange(0, 200)
        place = lambda: (float(rng.randrange(0, 60)), float(rng.randrange(0, 40)))
        rows.append(("h", i, s, s + rng.randrange(0, 50), *place(), *place()))
    rows += [("h", 3000 + i, 10 * i, 10 * i + 5, 1000.0 + 40 * i, 0.0, 1000.0 + 40 * i, 30.0) for i in range(30)]
    df = spark.createDataFrame(rows, "team string, piece long, start long, end long, x0 double, y0 double, x1 double, y1 double")
    out = tracks.stitch(df, ["team"], alone=0)
    assert {r.piece: r.track for r in out.collect()} == _stitched(rows)
    assert "Join" not in out._jdf.queryExecution().toString()


def test_ball_choice_of_a_crowd_by_bounds():
    """The candidate of least cost as counting all with all finds it, and without a matrix of the candidates' square."""
    import tracemalloc

    from pathloom.operators.chains import BallChoice

    rng = np.random.default_rng(4)
    for n, span in ((3, 30), (60, 40), (700, 100), (5, 2000)):
        for _ in range(20):
            choice = BallChoice(150.0, 5.0, 5, 50.0, 1000.0, (1060.0, 660.0))
            choice.recent = [(f, np.round(rng.uniform(-span, span, (n, 2)), 1)) for f in range(3)]
            here, base = np.round(rng.uniform(-span, span, (n, 2)), 1), np.round(rng.uniform(0, 900, n))
            before = np.concatenate([p for _, p in choice.recent])
            stood = (np.sqrt(((here[:, None] - before[None]) ** 2).sum(-1)) < 5.0).sum(1)
            assert choice._cheapest(here, base) == (base + 50.0 * stood).argmin()
    choice.pick(0, rng.uniform(0, 500, (4000, 2)))
    tracemalloc.start()
    choice.pick(1, rng.uniform(0, 500, (4000, 2)))
    assert tracemalloc.get_traced_memory()[1] < 30e6  # all with all took 256 MB for one of its arrays
    tracemalloc.stop()


def test_kernels_of_short_series_reuse_what_hangs_on_length_alone(monkeypatch):
    """Gains, draws and fits are worked out once a length; short and long ways agree."""
    from pathloom import numerics as N

    rng = np.random.default_rng(2)
    long, z = N.kalman_states(np.full(300, 5.0)), rng.exponential(50, 100)
    assert np.allclose(long[:, 0], 5.0)
    short = N.kalman_states(z)
    a, gains, back = N._gains(4, 1e-2, 4.0, 1.0, 128)
    x, seen, ahead = np.r_[z[0], 0, 0, 0], [], []
    for k in range(100):
        x = a @ x if k else x
        ahead.append(x)
        x = x + gains[k] * (z[k] - x[0])
        seen.append(x)
    for k in range(98, -1, -1):
        seen[k] = seen[k] + back[k] @ (seen[k + 1] - ahead[k + 1])
    assert np.allclose(short, seen, atol=1e-9)
    N.ransac_line(z, z, 1.0), N.savgol(z, 11, 3)
    for name in ("solve", "pinv"):
        monkeypatch.setattr(np.linalg, name, None)
    monkeypatch.setattr(np.random, "default_rng", None)
    N.kalman_states(z), N.savgol(z, 11, 3), N.ransac_line(z, z, 1.0)


def test_few_points_cluster_as_many_do():
    from pathloom import numerics as N

    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 100):
        p = np.round(rng.uniform(0, 100, (n, 2)), 1)
        far = np.c_[np.arange(200) * 1e4 + 1e6, np.zeros(200)]  # noise, so that there are many
        assert (N.dbscan(p, 15.0, 4) == N.dbscan(np.r_[p, far], 15.0, 4)[:n]).all()


def test_a_long_clip_is_tagged_by_columns(monkeypatch):
    """Whole skeletons never become Python lists."""
    from pathloom.operators import keeper

    monkeypatch.setattr(keeper, "_points", None)
    rng = np.random.default_rng(6)
    assert 8 in keeper._tags(rng.uniform(0, 300, (500, 17, 2)), rng.uniform(0, 300, (500, 4)), 10.0, keeper.Limits())


def test_small_teams_go_to_python_together(spark):
    """Teams are rows of a stream, not a Python call each."""
    t = [(f"t{i}", i * 100 + k, k / 100, 0, 50) for i in range(500) for k in range(13)]
    tracks_ = spark.createDataFrame(t, "team string, track long, conf double, start long, end long")
    w = spark.createDataFrame([(f"t{i}", 0, 50, 13, [i * 100 + k for k in range(13)]) for i in range(500)], "team string, start long, end long, n long, members array<long>")
    out = roster.relabel_in_turn(tracks_, w, 0.5)
    assert sorted(r.track for r in out.filter("relabelled").collect()) == [i * 100 + k for i in range(500) for k in range(3)]
    assert "CoGroup" not in out._jdf.queryExecution().toString()


def test_best_masks_by_blocks(spark):
    """The best of all pairs, whatever the blocks, without a row for each pair."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from pathloom.functions.geometry import packed_mask
    from pathloom.operators import evaluation

    rng = random.Random(1)
    rows = [(i % 3, str(i % 2), i, [rng.random() < 0.4 for _ in range(70 if i % 11 else 5)]) for i in range(300)] + [(0, "0", 900, [False] * 70), (0, "0", 901, None)]
    m = spark.createDataFrame(rows, "image long, cls string, det long, bits array<boolean>").select("image", "cls", "det", F.when(F.col("bits").isNotNull(), packed_mask(F.col("bits"))).alias("mask"))
    d, lab = m.filter("det % 4 < 2"), m.filter("det % 4 >= 2 OR det >= 900").withColumnRenamed("det", "lab")
    best = Window.partitionBy("image", "cls", "left_id").orderBy(F.desc("value"), "right_id")
    for least in (0.0, 0.3):
        want = {(r.left_id, r.right_id, r.value) for r in evaluation.mask_pairs(d, lab, ["image", "cls"], least).withColumn("r", F.row_number().over(best)).filter("r = 1").collect()}
        for block in (7, 4096):
            assert {(r.left_id, r.right_id, r.value) for r in evaluation.best_mask_pairs(d, lab, ["image", "cls"], least, block).collect()} == want and len(want) > 50


def test_a_polygon_is_not_closed_anew_for_each_point(spark):
    from pyspark.sql import functions as F

    from pathloom.functions.boxes import resampled

    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)],)], "p array<struct<x: double, y: double>>").select(resampled(F.col("p"), 7).alias("q"))
    assert [tuple(q) for q in df.first().q] == [(0.0, 0.0), (2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (4.0, 4.0), (2.0, 2.0), (0.0, 0.0)]
    assert "concat" not in df._jdf.queryExecution().optimizedPlan().toString()
