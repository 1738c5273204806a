"""Trackers, ring buffers, keeper tags and countdown, against worked examples and brute force; streams against tables."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.operators import keeper, roster, tracker
from pathloom.streaming import tracks as S


def test_assignment_is_the_cheapest():
    rng = np.random.default_rng(1)
    for n, m in itertools.product(range(1, 6), range(1, 6)):
        cost = rng.random((n, m))
        pairs = tracker.assignment(cost)
        short = min(n, m)
        if n <= m:
            best = min(sum(cost[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n))
        else:
            best = min(sum(cost[r, i] for i, r in enumerate(p)) for p in itertools.permutations(range(n), m))
        assert len(pairs) == short and sum(cost[r, c] for r, c in pairs) == pytest.approx(best)


def _walk(frames=40):
    """Two boxes that pass each other, one unseen for a while, one weak for a while, and a lone false box."""
    rows = []
    for f in range(frames):
        if not 15 <= f < 20:
            rows.append((f, 10.0 + 5 * f, 50.0, 0.9))
        rows.append((f, 300.0 - 5 * f, 200.0, 0.15 if 10 <= f < 14 else 0.8))
    rows.append((7, 500.0, 500.0, 0.9))
    return [("a", f, x, y, x + 40, y + 80, c) for f, x, y, c in rows]


SCHEMA = "file string, frame long, x1 double, y1 double, x2 double, y2 double, conf double"


def test_tracks_keep_their_numbers(spark):
    df = spark.createDataFrame(_walk() + [("b", *r[1:]) for r in _walk()], SCHEMA)
    got = tracker.track(df.repartition(4), ["file"]).collect()
    for file in "ab":
        first = {r.track for r in got if r.file == file and r.y1 == 50.0}
        second = {r.track for r in got if r.file == file and r.y1 == 200.0}
        assert len(first) == 1 and len(second) == 1 and first != second and None not in first | second
    assert len(got) == 2 * len(_walk())


def _at(df):
    """With the event time of 30 frames a second."""
    return df.withColumn("ts", F.timestamp_millis((F.lit(1e12) + F.col("frame") * 1000 / 30).cast("long")))


def test_streams_equal_tables(spark, tmp_path):
    rows = _walk()
    want = {(r.frame, r.x1): r.track for r in tracker.track(spark.createDataFrame(rows, SCHEMA), ["file"]).collect()}
    src = str(tmp_path / "boxes")
    for part in (rows[:30], rows[30:-1]):
        _at(spark.createDataFrame(part, SCHEMA)).coalesce(1).write.mode("append").parquet(src)
    stream = S.stream(spark, src, spark.read.parquet(src).schema)
    got = S.drain(S.tracked(stream, ["file"]), "tracked_boxes", str(tmp_path / "c1")).collect()
    assert {(r.frame, r.x1): r.track for r in got} == {k: v for k, v in want.items() if k != (7, 500.0)}
    frames = [("a", f, f in (8, 12, 40)) for f in range(60)]
    f_src = str(tmp_path / "frames")
    _at(spark.createDataFrame(frames, "file string, frame long, trigger boolean")).coalesce(1).write.parquet(f_src)
    one = tracker.ring_clips(spark.createDataFrame(frames, "file string, frame long, trigger boolean"), ["file"], "frame", "trigger", 5, 4, 20)
    f_stream = S.stream(spark, f_src, spark.read.parquet(f_src).schema)
    two = S.drain(S.ring_clips(f_stream, ["file"], 5, 4, 20), "ring", str(tmp_path / "c2"))
    clips = sorted((r.clip, r.frame) for r in one.collect())
    assert clips == [(1, f) for f in range(3, 12)] + [(2, f) for f in range(35, 44)]
    assert clips == sorted((r.clip, r.frame) for r in two.collect())
    late = S.drain(S.ascending(f_stream.select("file", "ts", F.when(F.col("frame") == 30, 2).otherwise(F.col("frame")).cast("long").alias("frame")), ["file"]), "late", str(tmp_path / "c3"))
    assert sorted(r.frame for r in late.collect()) == [f for f in range(60) if f != 30]


def _run(out, to, checkpoint):
    """Runs a stream over what is there now into Parquet files; gives the state rows that its last batch left."""
    q = out.writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]


def test_tracker_state_restarts_and_ends(spark, tmp_path):
    """The query ends and starts again in the middle; a file whose buffer has passed leaves no state."""
    rows = _walk()
    want = {(r.frame, r.x1): r.track for r in tracker.track(spark.createDataFrame(rows, SCHEMA), ["file"]).collect()}
    src, to, checkpoint = (str(tmp_path / n) for n in ("boxes", "out", "c"))
    put = lambda part: _at(spark.createDataFrame(part, SCHEMA)).coalesce(1).write.mode("append").parquet(src)
    put([r for r in rows if r[1] < 17])
    stream = S.tracked(S.stream(spark, src, spark.read.parquet(src).schema), ["file"])
    first = _run(stream, to, checkpoint)
    put([r for r in rows if r[1] >= 17])
    second = _run(stream, to, checkpoint)
    got = {(r.frame, r.x1): r.track for r in spark.read.parquet(to).collect()}
    assert got == want and first[-1] > 0 and second[-1] > 0
    put([("z", 30 * 3600, 0.0, 0.0, 9.0, 9.0, 0.01)])  # an hour on, and too weak to begin a track
    third = _run(stream, to, checkpoint)
    put([("y", 60 * 3600, 0.0, 0.0, 9.0, 9.0, 0.01)])
    fourth = _run(stream, to, checkpoint)
    # what a file without tracks holds is all that is left: those of files a and z are gone
    alone = str(tmp_path / "alone")
    _at(spark.createDataFrame([("y", 60 * 3600, 0.0, 0.0, 9.0, 9.0, 0.01)], SCHEMA)).write.parquet(alone)
    least = _run(S.tracked(S.stream(spark, alone, spark.read.parquet(alone).schema), ["file"]), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert third[-1] == fourth[-1] == least[-1] < second[-1]


def test_ring_and_top_end_too(spark, tmp_path):
    src = str(tmp_path / "frames")
    schema = "file string, frame long, trigger boolean"
    _at(spark.createDataFrame([("a", f, f == 8) for f in range(20)], schema)).coalesce(1).write.parquet(src)
    stream = S.stream(spark, src, spark.read.parquet(src).schema)
    makers = {"ring": lambda: S.ring_clips(stream, ["file"], 5, 4, 20, idle="1 minute"), "top": lambda: S.ascending(stream, ["file"], idle="1 minute")}
    before = {n: _run(f(), str(tmp_path / n), str(tmp_path / f"c-{n}"))[-1] for n, f in makers.items()}
    _at(spark.createDataFrame([("b", 30 * 600, False)], schema)).coalesce(1).write.mode("append").parquet(src)
    after = {n: _run(f(), str(tmp_path / n), str(tmp_path / f"c-{n}"))[-1] for n, f in makers.items()}
    assert before == after  # one key's state, that of b instead of a


def test_countdown_by_hand():
    # 12 members in [0, 100], 10 allowed: the two least sure leave; the other window is covered in part by one of them
    tracks = {i: (0.001 * i, 0, 100) for i in range(1, 13)} | {1: (0.001, 0, 60)}
    c = roster.Countdown([(0, 100, 12, frozenset(range(1, 13))), (50, 80, 12, frozenset(range(1, 13)))], tracks, 10, 0.007, 0.1)
    assert c.run() == {1, 2, 3}  # [61, 80] stays with 12, of which track 2 took one, so one more leaves
    assert roster.Countdown([(0, 9, 11, frozenset({1}))], {1: (0.5, 0, 9)}, 10, 0.007, 0.1).run() == set()


def test_relabel_in_turn(spark):
    t = spark.createDataFrame([("h", i, 0.001 * i, 0, 100) for i in range(1, 13)] + [("referee", 20, 0.001, 0, 9), ("referee", 21, 0.002, 0, 9)], "team string, track long, conf double, start long, end long")
    w = spark.createDataFrame([("h", 10, 60, 12, list(range(1, 13))), ("referee", 0, 9, 2, [20, 21])], "team string, start long, end long, n long, members array<long>")
    got = {r.track: (r.team, r.relabelled) for r in roster.relabel_in_turn(t, w).collect()}
    assert {k for k, v in got.items() if v[1]} == {1, 2, 20} and got[1][0] == "unsure" and got[20][0] == "referee" and got[3] == ("h", False)


def test_numbers_in_frames(spark):
    rows = [(1, "h", 1, 7, 0.9), (1, "h", 2, 7, 0.5), (1, "h", 3, 7, 0.4), (1, "h", 4, 17, 0.3), (2, "h", 2, 7, 0.5), (1, "h", 5, None, 0.1)]
    t = spark.createDataFrame(rows, "frame long, team string, track long, number int, conf double")
    r = spark.createDataFrame([("h", [7, 17, 27])], "team string, numbers array<int>")
    got = {(x.frame, x.track): (x.number, x.state) for x in roster.resolve_in_frames(t, r).collect()}
    assert got == {(1, 1): (7, "kept"), (1, 2): (27, "changed"), (1, 3): (None, "unsure"), (1, 4): (17, "kept"), (2, 2): (27, "changed"), (1, 5): (None, "kept")}


def _skeleton(shift=(0.0, 0.0), **moved):
    s = np.array([(100, 20), (98, 18), (102, 18), (95, 20), (105, 20), (85, 50), (115, 50), (75, 80), (125, 80), (70, 110), (130, 110), (90, 120), (110, 120), (88, 160), (112, 160), (86, 200), (114, 200)], float)
    for k, v in moved.items():
        s[int(k[1:])] = v
    return (s + shift).tolist()


def _ball(x, y, side=10.0):
    return [x - side / 2, y - side / 2, x + side / 2, y + side / 2]


def test_keeper_tags_by_worked_clips():
    still = [_skeleton()] * 12
    far = [_ball(1000, 1000)] * 12
    assert keeper.tags([None], [_ball(0, 0)], None) == [0] == keeper.tags([_skeleton()], [None], None)
    assert keeper.tags(still, far, 50.0) == [1, 2, 11]
    assert keeper.tags(still, far, 10.0) == [1, 2, 8, 11]
    # tag 3: the body ends further from where the ball is in the end
    away = [_skeleton((-10.0 * i, 0.0)) for i in range(12)]
    assert 3 in keeper.tags(away, [_ball(400, 100)] * 12, 50.0) and 3 not in keeper.tags(away[::-1], [_ball(400, 100)] * 12, 50.0)
    # tags 4 and 12: the ball above the ears, both ankles together moving by less than 20; opposite moves add up
    high = [_ball(100, 5)] * 3
    assert {4, 12} <= set(keeper.tags([_skeleton()] * 3, high, 50.0))
    jump = [_skeleton(), _skeleton(p15=(86, 212), p16=(114, 188)), _skeleton()]
    assert not {4, 12} & set(keeper.tags(jump, high, 50.0))
    # tag 5: one elbow below the ears is enough; a side that is never seen counts as 0
    up = dict(p7=(75, 10), p8=(125, 10))
    assert 5 in keeper.tags([_skeleton()] * 3, high, 50.0) and 5 in keeper.tags([_skeleton(p7=(75, 10))] * 3, high, 50.0) and 5 not in keeper.tags([_skeleton(**up)] * 3, high, 50.0)
    missing = _skeleton(p8=(125, 10))
    missing[7] = None
    assert 5 not in keeper.tags([missing] * 3, high, 50.0)
    # tags 6, 7 and 9: the ball by a shoulder; the right side needs no large ball
    by = [_ball(130, 50)] * 2
    bent = _skeleton(p10=(125, 55))
    assert keeper.tags([bent, bent], by, 50.0) == [6]
    assert set(keeper.tags([_skeleton(), bent], by, 10.0)) == {6, 7, 8, 9}
    left = [_ball(70, 50, 20)] * 2
    assert 6 not in keeper.tags([_skeleton(p9=(75, 55), p6=(300, 50), p8=(320, 80))] * 2, left, 50.0)
    assert 6 in keeper.tags([_skeleton(p9=(75, 55), p6=(300, 50), p8=(320, 80))] * 2, [_ball(70, 50, 60)] * 2, 50.0)
    # a bend that is over when the clip ends counts too
    assert 6 in keeper.tags([bent, _skeleton()], by, 50.0)
    # tag 10: the ball between the legs
    assert keeper.tags([_skeleton()], [_ball(100, 165)], 50.0) == [10]


def test_recent_centre(spark):
    rng = random.Random(1)
    rows = [(1, f, rng.random() * 9, rng.random() * 9) for f in range(30) for _ in range(rng.randrange(1, 4))]
    got = {r.frame: (r.x, r.y) for r in tracker.nearest_to_recent(spark.createDataFrame(rows, "m long, frame long, x double, y double"), ["m"], "frame", 5).collect()}
    for f in range(30):
        near = np.array([(x, y) for _, g, x, y in rows if f - 5 < g <= f])
        mine = sorted((x, y) for _, g, x, y in rows if g == f)
        assert got[f] == min(mine, key=lambda p: np.hypot(*(np.array(p) - near.mean(0))))
