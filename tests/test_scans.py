"""Scans in chunks, numbering, components and numbers of tracks, against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pathloom.operators import events, graphs, joins, numbering, roster, scans, stats, tall


@pytest.mark.parametrize("size", [7, 50, 100_000])
def test_cooldown_in_chunks(spark, size):
    rng = random.Random(1)
    rows = [(g, t) for g in ("a", "b", None) for t in sorted(rng.choices(range(900), k=400))] + [("a", None), ("c", 5)]
    got = defaultdict(list)
    for r in scans.cooldown(spark.createDataFrame(rows, "e string, t long").repartition(3), ["e"], "t", 23, size).collect():
        got[r.e].append(r.t)
    want = defaultdict(list)
    for g, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1]):
        if not want[g] or t - want[g][-1] >= 23:
            want[g].append(t)
    assert {g: sorted(v) for g, v in got.items()} == dict(want)


@pytest.mark.parametrize("size", [3, 40, 100_000])
def test_exponential_smoothing_in_chunks(spark, size):
    rng = random.Random(2)
    rows = [(g, i, None if rng.random() < 0.1 else rng.uniform(-5, 5)) for g in (1, 2, None) for i in range(130)]
    got = {(r.g, r.i): r.smoothed for r in scans.smooth_exponential(spark.createDataFrame(rows, "g int, i long, v double"), ["g"], "i", "v", 0.3, size).collect()}
    assert len(got) == len(rows)
    s, of = None, object()
    for g, i, v in rows:
        if g != of:
            s, of = None, g
        s = s if v is None else v if s is None else 0.3 * v + 0.7 * s
        assert got[g, i] == (None if s is None else pytest.approx(s, rel=1e-12))


def _plain_stays(rows, reach, least):
    out, at = [], None
    for frame, x, y, e in rows:
        if at is not None and e is not None and e == at[3] and ((x - at[1]) ** 2 + (y - at[2]) ** 2) ** 0.5 <= reach:
            at[4] += 1
            if at[4] >= least:
                out.append((e, at[0], frame))
                at = None
        else:
            at = [frame, x, y, e, 1]
    return out


@pytest.mark.parametrize("size", [5, 64, 100_000])
@pytest.mark.parametrize("least", [1, 2, 9, 30])
def test_delayed_restart_in_chunks(spark, size, least):
    rng = random.Random(3)
    ball, owner, want = [], [], []
    for match in ("m1", "m2"):
        x, y, e, rows = 0.0, 0.0, 1, []
        for f in range(0, 1200, 3):
            if rng.random() < 0.05:
                x, y = rng.uniform(0, 50), rng.uniform(0, 50)
            if rng.random() < 0.02:
                e = rng.choice([1, 2, None])
            x += rng.uniform(-0.4, 0.4)
            rows.append((f, x, y, e))
        ball += [(match, f, x, y) for f, x, y, _ in rows]
        owner += [(match, f, e) for f, _, _, e in rows if e is not None]
        want += [(match, *w) for w in _plain_stays(rows, 3.0, least)]
    b = spark.createDataFrame(ball, "match string, frame long, bx double, by double")
    got = events.delayed_restart(b, spark.createDataFrame(owner, "match string, frame long, entity long"), 3.0, least, ("match",), size)
    assert sorted(map(tuple, got.select("match", "entity", "start", "end").collect())) == sorted(want) and len(want) > 1


def test_numbered_over_many_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.randrange(300), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, i long")
    got = numbering.numbered(df, ["g"], ["o", F.desc("i")]).collect()
    by = defaultdict(list)
    for g, o, i in sorted(rows, key=lambda r: (r[1], -r[2])):
        by[g].append((o, i))
    assert len(got) == 3000 and all(by[r.g][r.pos] == (r.o, r.i) for r in got)
    plan = numbering.numbered(df, [], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition" in plan and "windowspecdefinition(o" not in plan  # only a row a range goes through a window


def test_positions_batches_and_best_so_far(spark):
    left = spark.createDataFrame([(i, -i) for i in range(500)], "a long, b long").repartition(7)
    right = spark.createDataFrame([(i, f"{i:03d}") for i in range(500)], "c long, d string").repartition(5)
    got = joins.by_position(left, right, "b", "d").collect()
    assert len(got) == 500 and all(r.a + r.c == 499 for r in got)
    images = spark.createDataFrame([(f"i{i}", ((i * 37) % 100) / 50) for i in range(100)], "image string, ratio double")
    batches = defaultdict(list)
    for r in stats.aspect_batches(images, "image", "ratio", 16).collect():
        batches[r.batch].append((r.ratio, r.image))
    order = sorted((((i * 37) % 100) / 50, f"i{i}") for i in range(100))
    assert [sorted(batches[k]) for k in sorted(batches)] == [order[k : k + 16] for k in range(0, 100, 16)]
    rng = random.Random(5)
    values = [rng.random() for _ in range(400)]
    best = {r.i: r.best for r in stats.evolution(spark.createDataFrame(list(enumerate(values)), "i long, v double").repartition(6), "i", F.col("v")).collect()}
    assert [best[i] for i in range(400)] == [max(values[: i + 1]) for i in range(400)]


def test_changes_over_chunks(spark):
    rng = random.Random(6)
    rows = [(m, f, rng.choice([1, 1, 1, 2, None])) for m in "ab" for f in sorted(rng.sample(range(5000), 400))]
    for size in (10, 333, 10_000):
        got = {(r.m, r.f): r.run for r in tall.changes(spark.createDataFrame(rows, "m string, f long, e int"), ["m"], "f", ["e"], "run", size).collect()}
        run, last = 0, ()
        for m, f, e in rows:
            run = 1 if last[:1] != (m,) else run + (e != last[1])
            last = (m, e)
            assert got[m, f] == run


def test_sidecars_of_short_names(spark):
    videos = spark.createDataFrame([("a",), ("ab",), ("game_1",), ("none",)], "v string")
    files = spark.createDataFrame([("a.tracks", 1), ("ab.tracks", 1), ("ab.tracks2", 9), ("game_1.tracks", 1), ("game_1.dets", 1), ("game_10.tracks", 5)], "f string, t long")
    assert {r.v: r.f for r in joins.sidecars(videos, files, "v", "f", "tracks", "t").collect()} == {"a": "a.tracks", "ab": "ab.tracks", "game_1": "game_1.tracks"}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (100, 95), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graphs.components(links, spark.createDataFrame([(200,), (3,)], "node long")).collect()}
    assert got == {i: 0 for i in range(61)} | {90: 90, 95: 90, 100: 90, 200: 200}


def test_no_frame_holds_a_number_twice(spark):
    rng = random.Random(7)
    numbers = [1, 2, 11, 12, 21, 22, 30]
    rows = []
    for match in ("m", "n"):
        for track in range(14):
            a, worn = rng.randrange(40), rng.choice([1, 2, 11, 12])
            rows += [(match, f, "h", track, worn, round(rng.random(), 3)) for f in range(a, a + rng.randrange(5, 30))]
    rows.append(("m", 0, "h", 99, None, 0.5))
    df = spark.createDataFrame(rows, "match string, frame long, team string, track long, number int, conf double")
    got = roster.resolve_in_frames(df, spark.createDataFrame([("h", numbers)], "team string, numbers array<int>"), ("match",)).collect()
    assert len(got) == len(rows)
    worn, before = defaultdict(list), {r[:4]: r[4:] for r in rows}
    for r in got:
        if r.number is not None:
            worn[r.match, r.frame].append(r.number)
    assert all(len(v) == len(set(v)) for v in worn.values())
    # by hand: who gives way, in what order, to what
    in_frame = defaultdict(list)
    for m, f, _, t, n, c in rows:
        if n is not None:
            in_frame[m, f].append((n, -c, t))
    lost = {(m, t, n) for (m, f), v in in_frame.items() for n, c, t in v if any(o[0] == n and o[1:] < (c, t) for o in v)}
    frames, conf = defaultdict(set), defaultdict(list)
    for m, f, _, t, n, c in rows:
        frames[m, t, n].add(f)
        conf[m, t, n].append(c)
    choice = {}
    for k in sorted(lost, key=lambda k: (-sum(conf[k]) / len(conf[k]), k[1])):
        m, t, n = k
        others = {o for f in frames[k] for o, _, u in in_frame[m, f] if u != t} | {choice[j] for j in choice if j[0] == m and frames[j] & frames[k]}
        similar = [o for o in numbers if o != n and (str(n) in str(o) if n < 10 else str(o)[0] == str(n)[0] or str(o)[-1] == str(n)[-1])]
        choice[k] = next((o for o in similar if o not in others), None)
    for r in got:
        was = before[r.match, r.frame, r.team, r.track][0]
        k = (r.match, r.track, was)
        assert (r.number, r.state) == ((choice[k], "changed" if choice[k] is not None else "unsure") if k in lost else (was, "kept"))
    assert {"kept", "changed", "unsure"} == {r.state for r in got}


MATCH_RULES = {
    "turnovers": lambda p, b, o, r, m: events.turnovers(r, 0, m),
    "possession_share": lambda p, b, o, r, m: events.possession_share(r, m),
    "opposite_direction": lambda p, b, o, r, m: events.opposite_direction(p, b, radius=90.0, share=0.0, least_valid=1, least=1, growth=-1e9, match=m),
    "stationary": lambda p, b, o, r, m: events.stationary(p, b, 90.0, 8.0, -1e9, match=m),
    "velocity": lambda p, b, o, r, m: events.velocity(p, match=m).select(*m, "entity", "frame", "speed"),
    "steps": lambda p, b, o, r, m: events.steps(p, b, match=m).select(*m, "entity", "frame", "dx", "bdy", "gap"),
    "slow_near_goal": lambda p, b, o, r, m: events.slow_near_goal(p, b, o, (0.0, 50.0), 60.0, slow=40.0, least=1, match=m),
    "unpressured_loss": lambda p, b, o, r, m: events.unpressured_loss(p, b, r, 40.0, 20.0, match=m),
    "passive_near_ball": lambda p, b, o, r, m: events.passive_near_ball(p, b, o, 60.0, 40.0, 1, match=m),
    "outpaced": lambda p, b, o, r, m: events.outpaced(p, b, 90.0, 1.0, 5, 1, match=m),
}


@pytest.fixture(scope="module")
def two_matches(spark):
    rng = random.Random(8)
    points, ball = [], []
    for m in ("m1", "m2"):
        for f in range(60):
            ball.append((m, f, rng.uniform(0, 100), rng.uniform(0, 100)))
            points += [(m, e, "hg"[e % 2], f, rng.uniform(0, 100), rng.uniform(0, 100)) for e in range(6)]
    return spark.createDataFrame(points, "match string, entity long, team string, frame long, x double, y double"), spark.createDataFrame(ball, "match string, frame long, bx double, by double")


@pytest.mark.parametrize("rule", MATCH_RULES)
def test_two_matches_are_apart(spark, two_matches, rule):
    """Both matches at once give what each gives alone."""

    def run(p, b, m):
        o = events.nearest_player(p, b, 60.0, m).select(*m, "frame", F.col("team").alias("owner_team"))
        out = MATCH_RULES[rule](p, b, o, events.possession_runs(p, b, 60.0, 1, m), m)
        return out, [c for c in out.columns if c != "match"]

    whole, columns = run(*two_matches, ("match",))
    got = sorted(map(str, whole.select("match", *columns).collect()))
    want = []
    for m in ("m1", "m2"):
        alone, _ = run(*(t.filter(F.col("match") == m).drop("match") for t in two_matches), ())
        want += map(str, alone.select(F.lit(m).alias("match"), *columns).collect())
    assert got == sorted(want) and got


def test_goal_follows_the_keepers(spark):
    """The team in possession attacks away from its keeper; only frames with the ball in that half count."""
    frames = range(10)
    side = spark.createDataFrame([(f, "a" if f >= 5 else None) for f in frames], "frame long, left_team string")
    # until frame 5 the first team by name attacks to the left; from then on its keeper is on the left, so it attacks to the right
    points = spark.createDataFrame([(1, "b", f, 40.0, 330.0) for f in frames] + [(2, "b", f, 1020.0, 330.0) for f in frames], "entity long, team string, frame long, x double, y double")
    ball = spark.createDataFrame([(f, 100.0 if f != 3 else 900.0, 330.0) if f < 5 else (f, 1000.0 if f != 8 else 200.0, 330.0) for f in frames], "frame long, bx double, by double")
    owner = spark.createDataFrame([(f, "a") for f in frames], "frame long, owner_team string")
    got = events.slow_near_goal(points, ball, owner, None, 100.0, least=1, sides=side)
    assert sorted((r.entity, r.n, r.first, r.last) for r in got.collect()) == [(1, 3, 1, 4), (2, 4, 5, 9)]
