"""Worked examples of the column functions, the operators and the kernels."""

import hashlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom import numerics as N
from pathloom.functions import boxes as B
from pathloom.functions import geometry as G
from pathloom.functions import labels as L
from pathloom.functions import times as T
from pathloom.operators import boxes, chains, joins, scans, stats, tall, vectors
from pathloom.sources import files
from pathloom.streaming import tracks as streaming


def value(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def lit(*v):
    return [F.lit(float(x)) for x in v]


def test_geometry(spark):
    h = [2, 0, 10, 0, 3, -5, 0, 0.01, 1]
    assert value(spark, *G.homography(h, *lit(0, 0)), *G.homography(h, *lit(10, 20))) == pytest.approx((10, -5, 25, 45.8333), abs=1e-4)
    assert value(spark, G.angle_between(*lit(1, 0, -1, 1)), G.angle_between(*lit(1, 0, 0, 2)), G.angle_between(*lit(0, 0, 1, 1))) == pytest.approx((135, 90, 0))
    inv = G.inverse_homography(h)
    x, y = value(spark, *G.homography(inv, *lit(10, -5)))
    assert (x, y) == pytest.approx((0, 0), abs=1e-9)
    square = [tuple(lit(0, 0)), tuple(lit(4, 0)), tuple(lit(4, 4)), tuple(lit(0, 4))]
    assert value(spark, G.inside_polygon(*lit(1, 1), square), G.inside_polygon(*lit(4, 1), square), G.inside_polygon(*lit(5, 1), square)) == (True, False, False)
    p, q = (F.array(*lit(*v)) for v in ((0.5, 0.5, 0), (0.25, 0.25, 0.5)))
    assert value(spark, G.bhattacharyya_similarity(p, q))[0] == pytest.approx(0.458804, abs=1e-6)


def test_fit_homography():
    src = [(0, 0), (10, 0), (10, 10), (0, 10), (5, 5)]
    dst = [(1, 1), (21, 1), (21, 31), (1, 31), (400, 400)]
    assert np.allclose(G.fit_homography(src, dst), [[2, 0, 1], [0, 3, 1], [0, 0, 1]], atol=1e-6)
    with pytest.raises(ValueError):
        G.fit_homography(src[:3], dst[:3])


def test_boxes(spark):
    a, b, c = lit(0, 0, 10, 10), lit(5, 5, 15, 15), lit(1, 1, 9, 9)
    assert value(spark, B.iou(a, b), B.over_smaller(a, c), B.area_ratio(a, c)) == pytest.approx((0.142857, 1.0, 0.64), abs=1e-5)
    assert B.tiles(100, 50, 40, 10) == [(0, 0, 40, 40), (30, 0, 70, 40), (60, 0, 100, 40), (0, 10, 40, 50), (30, 10, 70, 50), (60, 10, 100, 50)]


def test_times(spark):
    f = [T.video_frame(F.lit(v), 317, 3085, 3982) for v in (0, 30, 82_957, 100_000)]
    # the first half ends with frame 82956, so 82957 opens the second
    assert value(spark, *f) == (9500, 9530, 119_340, 136_383)
    assert value(spark, T.kmh(F.lit(26.0), F.lit(" mph ")))[0] == pytest.approx(41.84284)
    assert value(spark, T.frame_clock(F.lit(2997)), T.frame_minutes(F.lit(2997))) == ("00:01:40.000", "001:40")
    assert value(spark, *T.chapter(F.lit("gx021234.MP4")), *T.chapter(F.lit("clip.mp4"))) == ("1234", 2, "clip", 0)


def test_labels(spark):
    one = L.similar_numbers(F.lit(7), F.array(*map(F.lit, (7, 17, 27, 70, 8))))
    two = L.similar_numbers(F.lit(28), F.array(*map(F.lit, (2, 20, 38, 28, 82))))
    assert value(spark, one, two) == ([7, 17, 27, 70], [2, 20, 38, 28])
    assert [L.letters(i) for i in (0, 25, 26, 27, 701, 702)] == ["a", "z", "aa", "ab", "zz", "aaa"]
    scores = F.create_map(F.lit("home"), F.lit(0.9), F.lit("away"), F.lit(0.9))
    assert value(spark, L.map_argmax(scores), L.map_argmax(F.create_map().cast("map<string,double>")), L.number_or(F.lit("x1"))) == ("home", "ball", -1)
    assert value(spark, L.ctc_collapse(F.array(*map(F.lit, (0, 1, 1, 0, 1, 2, 2))))) == ([1, 1, 2],)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_tall(spark):
    t = frame(spark, [(1, 10, 0.0), (1, 14, 8.0)], "e long, f long, x double")
    assert [tuple(r) for r in tall.interpolate(t, ["e"], "f", ["x"]).orderBy("f").select("f", "x").collect()] == [(10, 0.0), (11, 2.0), (12, 4.0), (13, 6.0), (14, 8.0)]
    m = frame(spark, [(1, i, v) for i, v in enumerate([True, False, False, True, False])], "e long, i long, m boolean")
    assert [r.filled for r in tall.fill_gaps(m, ["e"], "i", "m", 2).orderBy("i").collect()] == [True, True, True, True, False]
    assert sorted(tuple(r) for r in tall.runs(m, ["e"], "i", "m").filter("m").select("start", "end").collect()) == [(0, 0), (3, 3)]
    c = frame(spark, [(1, v) for v in (100, 130, 900, 950, 2000, 2010)], "e long, t long")
    assert sorted(r.t for r in scans.cooldown(c, ["e"], "t", 900).collect()) == [100, 2000]
    w = frame(spark, [(1, v) for v in (100, 350, 1400)], "e long, t long")
    assert sorted(tuple(r) for r in tall.clip_windows(w, ["e"], "t", 150, 150).select("start", "end", "trigger").collect()) == [(0, 500, 100), (1250, 1550, 1400)]
    s = frame(spark, [(1, i, i + 1, float(i * i), 0.0) for i in range(9)], "e long, frame long, rn long, x double, y double")
    got = tall.sampled_speed(s, ["e"], "frame", "rn", 2, 30.0).orderBy("rn").collect()
    assert [round(r.metres, 6) for r in got] == [0.4, 1.2, 2.0, 2.8] and [round(r.kmh, 6) for r in got] == [21.6, 64.8, 108.0, 151.2]
    st = stats.speed_statistics(s, ["e"], 2, 30.0).first()
    assert (st.mean_kmh, st.max_kmh, st.p10_kmh) == pytest.approx((86.4, 151.2, 34.56))
    assert stats.split_ratios(s, ["e"], 0.5, 2, 30.0).first().speed_ratio == pytest.approx(3.0)


def test_joins(spark):
    a = frame(spark, [(1, 1, 1, 0.9), (1, 1, 2, 0.8), (1, 2, 1, 0.85)], "g long, l long, r long, s double")
    assert sorted(tuple(x)[1:3] for x in joins.greedy_pairs(a, ["g"], "l", "r", "s").collect()) == [(1, 1)]
    left = frame(spark, [(1, 100)], "k long, t long")
    right = frame(spark, [(1, 39), (1, 40), (1, 105), (1, 161)], "k long, u long")
    assert sorted(r.u for r in joins.band(left, right, ["k"], "t", "u", 60, 60).collect()) == [40, 105]


def test_average_precision(spark):
    d = frame(spark, [("a", 1, 0.9, 1), ("a", 2, 0.8, 0), ("a", 3, 0.7, 1)], "cls string, id long, score double, hit int")
    curve = stats.precision_recall(d, "cls", "score", "hit", d.groupBy("cls").agg(F.sum("hit").alias("positives")))
    assert stats.average_precision(curve, "cls").first().ap == pytest.approx(0.828333, abs=6e-3)


def test_numerics():
    x = np.linspace(0, 1, 50)
    assert np.allclose(N.savgol(x**3, 11, 3), x**3)
    assert N.peaks(np.array([0, 2, 1, 5, 0, 1, 0.5]), 0.9).tolist() == [1, 3]
    p = np.array([[0, 0], [0, 1], [1, 0], [9, 9]], float)
    assert N.dbscan(p, 1.5, 3).tolist() == [0, 0, 0, -1]
    m, c, ok = N.ransac_line(np.arange(10.0), np.r_[2 * np.arange(9.0) + 1, 90], 0.5)
    assert (round(m, 6), round(c, 6), ok.sum()) == (2, 1, 9)
    z = np.arange(30.0)
    assert np.abs(N.kalman_smooth(z) - z)[3:-3].max() < 0.2
    assert N.true_runs([1, 1, 0, 1]) == [(0, 1), (3, 3)]


def test_boxes_of_labels(spark):
    assert value(spark, *B.to_pixels(lit(0.5, 0.5, 0.2, 0.4), 100, 50, 3.0, 4.0)) == pytest.approx((43, 19, 63, 39))
    assert value(spark, L.detection_text(F.lit("ball"), F.lit(0.456))) == ("ball 0.46",)


def test_text_columns(spark):
    t = frame(spark, [("ﬁn é 12",), (None,), ("",)], "t string")
    assert [r[0] for r in t.select(L.fold_ascii("t")).collect()] == ["fin e 12", None, ""]
    got = value(spark, L.content_key(F.array(F.lit("a"), F.lit("b")), F.array(F.lit(3), F.lit(4))))
    assert got == (hashlib.md5(b"7ab").hexdigest(),)
    parts = {r["p"]: r["count"] for r in spark.range(5000).select(L.split_of(F.col("id")).alias("p")).groupBy("p").count().collect()}
    assert set(parts) == {"train", "val"} and 0.87 < parts["train"] / 5000 < 0.93


def test_cosine_and_histograms(spark):
    a = lambda *v: F.array(*lit(*v))
    assert value(spark, G.cosine_similarity(a(1, 0), a(1, 1)), G.cosine_similarity(a(0, 0), a(1, 1))) == (pytest.approx(0.5**0.5), None)
    rng = np.random.default_rng(6)
    p = rng.random((30, 5)).tolist()
    p[7], p[8], p[9] = [0.0] * 5, None, p[3]
    df = frame(spark, [(i, f"t{i % 4}", h) for i, h in enumerate(p)], "id long, team string, h array<double>")
    refs = vectors.team_histograms(df, "team", "h")
    means = {t: np.mean([h for i, h in enumerate(p) if h is not None and f"t{i % 4}" == t], axis=0) for t in ("t0", "t1", "t2", "t3")}
    assert {r.team: pytest.approx(r.histogram) for r in refs.collect()} == {t: m.tolist() for t, m in means.items()}
    alike = lambda x, y: 1 - max(0.0, 1 - np.sqrt(np.multiply(x, y)).sum() / (sum(x) * sum(y)) ** 0.5) ** 0.5
    for held in (1 << 20, 50):  # beside one broadcast, and in blocks
        got = {r.id: r for r in vectors.match_histograms(df, "id", "h", refs, held).collect()}
        assert len(got) == 30 and got[7].team is None and got[8].team is None
        for i in set(range(30)) - {7, 8}:
            team = max(means, key=lambda t: alike(p[i], means[t]))
            assert (got[i].team, got[i].similarity) == (team, pytest.approx(alike(p[i], means[team])))
    assert not vectors.match_histograms(df.limit(0), "id", "h", refs).collect()
    assert not vectors.match_histograms(df, "id", "h", refs.limit(0)).collect()


def test_labels_of_many_bytes_meet_in_blocks(spark):
    rng = np.random.default_rng(7)
    df = frame(spark, [(i, rng.standard_normal(4).tolist(), i % 6) for i in range(60)], "id long, v array<double>, label int")
    read = lambda held: {(r.id, r.team): pytest.approx(r.score) for r in vectors.mean_similarity(df, "id", "v", "label", held).collect()}
    assert read(1 << 20) == {k: v.expected for k, v in read(40).items()} and len(read(40)) == 360


def test_classes_of_a_box(spark):
    rows = [(1, 0, 0.0, 0.0, 10.0, 10.0, [0.9, 0.8, None]), (1, 1, 1.0, 0.0, 11.0, 10.0, [0.5, 0.85, float("nan")]), (1, 2, 50.0, 0.0, 60.0, 10.0, [0.3, 0.3, 0.1]), (1, 3, 0.0, 0.0, 1.0, 1.0, None), (1, 4, 0.0, 0.0, 1.0, 1.0, [])]
    df = frame(spark, rows, "image long, det long, x1 double, y1 double, x2 double, y2 double, s array<double>")
    read = lambda **k: sorted((r.det, r.cls) for r in boxes.suppress(boxes.class_candidates(df, "s", 0.25, **k), "image", 0.0, 0.5, None, None).collect())
    assert read() == [(0, 0), (1, 1), (2, 0), (2, 1)] and read(many=False) == [(0, 0), (1, 1), (2, 0)] and read(classes=[0]) == [(0, 0), (2, 0)]
    best = boxes.suppress(boxes.class_candidates(df, "s"), "image", 0.0, 0.5, 1, None).collect()
    assert [(r.det, r.cls) for r in best] == [(0, 0)]


def test_static_free_ball(spark):
    rows = [(f, 100.0, 100.0) for f in range(60)] + [(60 + f, 10.0 * f, 300.0) for f in range(50)] + [(200, -5.0, 1.0)]
    kept = chains.static_free_ball(frame(spark, rows, "frame long, x double, y double")).collect()
    assert {r.frame for r in kept} == set(range(60, 110))


def test_logs_and_results(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"type": "meta", "fps": 30.0}\n{"type": "det", "clip_frame": 3, "conf": 0.5}\n{"clip_frame": 4}\n')
    meta, rest = files.read_tagged(spark, str(tmp_path / "log.jsonl"))
    assert [r.fps for r in meta.collect()] == [30.0] and sorted(r.clip_frame for r in rest.collect()) == [3, 4]
    files.write_coco(frame(spark, [(9, 2, 1.0, 2.0, 4.00049, 8.0, 0.123456)], "image long, cls int, x1 double, y1 double, x2 double, y2 double, conf double"), str(tmp_path / "coco"))
    assert [tuple(r) for r in spark.read.schema("image_id long, category_id int, bbox array<double>, score double").json(str(tmp_path / "coco")).collect()] == [(9, 2, [1.0, 2.0, 3.0, 6.0], 0.12346)]
    tracks = frame(spark, [([3, 900, 5],), ([1],), (None,)], "frame_id array<long>")
    assert files.largest_frame(tracks).first().last == 900 and files.largest_frame(tracks.limit(0)).first().last is None


def test_track_arrays_of_a_stream(spark, tmp_path):
    base = datetime(2024, 1, 1)
    rows = [(t, f, float(f), 1.0, base + timedelta(minutes=f + (300 if f > 5 else 0))) for t in (1, 2) for f in (2, 1, 7, 5)]
    rows.append((9, 0, 0.0, 0.0, base + timedelta(days=9)))
    df = spark.createDataFrame(rows, "track_id long, frame long, x double, y double, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    want = {(t, f) for t in (1, 2) for f in ((1, 2, 5), (7,))}
    batch = streaming.track_arrays(df).filter("track_id < 9").collect()
    assert {(r.track_id, tuple(r.frame_id)) for r in batch} == want and all([p[0] for p in r.projected] == r.frame_id for r in batch)
    live = streaming.drain(streaming.track_arrays(streaming.stream(spark, str(tmp_path / "in"), df.schema)), "live_arrays", str(tmp_path / "cp"))
    assert {(r.track_id, tuple(r.frame_id)) for r in live.collect()} == want
