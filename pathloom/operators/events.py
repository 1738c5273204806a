"""Possession and rule-based behaviour over points (entity, team, frame, x, y) and the ball (frame, bx, by).

All rules are joins on the frame, windows by entity and conditional aggregates; the joined table is the only one
worth keeping between them. Frames are whole numbers; `fps` and `unit` (metres a coordinate) turn steps into speeds.
`match` names the columns that tell matches apart; all tables have them. What runs over a match's frames is windowed in chunks of frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import angle_between, distance
from ..storage import stored
from . import scans, tall


def with_ball(points: DataFrame, ball: DataFrame, match: tuple = ()) -> DataFrame:
    """Points of frames that have a ball, with their distance to it."""
    return points.join(ball, [*match, "frame"]).withColumn("dist", distance(F.col("x"), F.col("y"), F.col("bx"), F.col("by")))


def nearest_player(points: DataFrame, ball: DataFrame, radius: float, match: tuple = ()) -> DataFrame:
    """(match, frame, entity, team, dist): who is nearest to the ball in a frame, within the radius; ties to the smaller entity."""
    return _owners(points, ball, radius, match).filter("dist IS NOT NULL")


def _owners(points: DataFrame, ball: DataFrame, radius: float, match: tuple) -> DataFrame:
    """nearest_player() with a row for every frame that has a ball and players; where nobody is near all else is null."""
    near = F.when(F.col("dist") <= radius, F.struct("dist", "entity", "team"))
    by = with_ball(points, ball, match).groupBy(*match, "frame").agg(F.min(near).alias("_n"))
    return by.select(*match, "frame", F.col("_n.entity").alias("entity"), F.col("_n.team").alias("team"), F.col("_n.dist").alias("dist"))


def possession_runs(points: DataFrame, ball: DataFrame, radius: float, least: int = 3, match: tuple = ()) -> DataFrame:
    """(match, run, entity, team, start, end, n): the same nearest player on successive eligible frames, `least` frames or more.

    Eligible are frames with a ball and players; a frame with nobody near ends a run.
    """
    owner = stored(_owners(points, ball, radius, match).drop("dist"), "owners")  # read twice below
    owner = tall.changes(owner, list(match), "frame", ["entity"], "run")
    out = owner.filter("entity IS NOT NULL").groupBy(*match, "run", "entity", "team").agg(F.min("frame").alias("start"), F.max("frame").alias("end"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= least)


def possession_share(runs: DataFrame, match: tuple = ()) -> DataFrame:
    """(match, team, entity, frames, share): shares of a match's frames. A row a player goes through the window."""
    by = runs.groupBy(*match, "team", "entity").agg(F.sum("n").alias("frames"))
    return by.withColumn("share", F.col("frames") / F.sum("frames").over(Window.partitionBy(*(match or [F.lit(1)]))))


def possession_changes(runs: DataFrame, match: tuple = ()) -> DataFrame:
    """Runs whose team differs from that of the run before: (match, run, start, entity, team, lost_by, lost_team)."""
    runs = stored(runs, "runs")
    out = tall.previous(runs, list(match), "start", ["entity", "team"]).filter("prev_team <> team")
    return out.select(*match, "run", "start", "entity", "team", F.col("prev_entity").alias("lost_by"), F.col("prev_team").alias("lost_team"))


def change_frames(runs: DataFrame, points: DataFrame, ball: DataFrame, last: int = 10, match: tuple = ()) -> DataFrame:
    """(match, run, entity, frame): for each run whose next run is another team's the frame of its last `last` ones in which the player was
    nearest to the ball, one before the very last frame if it is that."""
    lost = tall.previous(stored(runs, "runs"), list(match), "start", ["team"], ahead=True).filter("next_team <> team")
    tail = lost.select(*match, "run", "entity", "end", F.explode(F.sequence(F.greatest("start", F.col("end") - last + 1), "end")).alias("frame"))
    near = with_ball(tail.join(points.select(*match, "entity", "frame", "x", "y"), [*match, "entity", "frame"]), ball, match)
    best = near.groupBy(*match, "run", "entity", "end").agg(F.min(F.struct("dist", "frame")).alias("m"))
    return best.select(*match, "run", "entity", F.when(F.col("m.frame") == F.col("end"), F.col("end") - 1).otherwise(F.col("m.frame")).alias("frame"))


def turnovers(runs: DataFrame, most: int = 8, match: tuple = ()) -> DataFrame:
    """(match, entity, n, start, end) of players with more than `most` runs in a match; the span is that of their first run."""
    first = F.min(F.struct("start", "end"))
    return runs.groupBy(*match, "entity").agg(F.count("*").alias("n"), first.alias("f")).filter(F.col("n") > most).select(*match, "entity", "n", F.col("f.start").alias("start"), F.col("f.end").alias("end"))


def steps(points: DataFrame, ball: DataFrame, excluded: DataFrame | None = None, match: tuple = ()) -> DataFrame:
    """Points with ball, with the displacement of player and ball since the entity's row before: dx, dy, bdx, bdy, gap (frames).
    `excluded`: (match, frame) to leave out."""
    both = with_ball(points, ball, match)
    if excluded is not None:
        both = both.join(excluded, [*match, "frame"], "left_anti")
    w = Window.partitionBy(*match, "entity").orderBy("frame")
    for c, name in (("x", "dx"), ("y", "dy"), ("bx", "bdx"), ("by", "bdy"), ("frame", "gap")):
        both = both.withColumn(name, F.col(c) - F.lag(c).over(w))
    return both


def _size(a: str, b: str) -> Column:
    return F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))


def opposite_direction(points: DataFrame, ball: DataFrame, excluded: DataFrame | None = None, radius: float = 200.0, angle: float = 120.0, share: float = 0.7, least_valid: int = 5, least: int = 3, growth: float = 50.0, match: tuple = ()) -> DataFrame:
    """Players who move against the ball: (match, entity, valid, abnormal, first, last)."""
    s = steps(points, ball, excluded, match).filter((F.col("dist") <= radius) & (_size("dx", "dy") >= 1e-2) & (_size("bdx", "bdy") >= 1e-2))
    s = s.withColumn("bad", angle_between(F.col("dx"), F.col("dy"), F.col("bdx"), F.col("bdy")) > angle)
    bad = lambda e: F.when(F.col("bad"), e)
    out = s.groupBy(*match, "entity").agg(F.count("*").alias("valid"), F.count_if("bad").alias("abnormal"), F.min(bad(F.struct("frame", "dist"))).alias("a"), F.max(bad(F.struct("frame", "dist"))).alias("b"))
    out = out.filter((F.col("valid") >= least_valid) & (F.col("abnormal") >= least) & (F.col("abnormal") > share * F.col("valid")) & (F.col("b.dist") - F.col("a.dist") > growth))
    return out.select(*match, "entity", "valid", "abnormal", F.col("a.frame").alias("first"), F.col("b.frame").alias("last"))


def stationary(points: DataFrame, ball: DataFrame, radius: float = 100.0, still: float = 1e-2, growth: float = 0.5, least: int = 1, match: tuple = ()) -> DataFrame:
    """Players near a moving ball who stand: (match, entity, n, first, last), if the ball got away by more than `growth` in the end."""
    s = steps(points, ball, match=match).filter((F.col("dist") <= radius) & (_size("dx", "dy") <= still) & (_size("bdx", "bdy") >= 1e-2))
    out = s.groupBy(*match, "entity").agg(F.count("*").alias("n"), F.min(F.struct("frame", "dist")).alias("a"), F.max(F.struct("frame", "dist")).alias("b"))
    return out.filter((F.col("n") >= least) & (F.col("b.dist") - F.col("a.dist") > growth)).select(*match, "entity", "n", F.col("a.frame").alias("first"), F.col("b.frame").alias("last"))


def velocity(points: DataFrame, fps: float = 30.0, unit: float = 0.1, most_gap: int = 1, match: tuple = ()) -> DataFrame:
    """Adds speed in m/s since the row before, where that is at most `most_gap` frames back."""
    w = Window.partitionBy(*match, "entity").orderBy("frame")
    gap = F.col("frame") - F.lag("frame").over(w)
    d = distance(F.col("x"), F.col("y"), F.lag("x").over(w), F.lag("y").over(w))
    return points.withColumn("speed", F.when(gap <= most_gap, d * fps * unit / gap))


def slow_near_goal(points: DataFrame, ball: DataFrame, owner: DataFrame, goal: tuple[float, float] | None, radius: float, closest: int = 3, slow: float = 1.5, least: int = 200, match: tuple = (), sides: DataFrame | None = None, width: float = 1060.0, height: float = 660.0, **speed) -> DataFrame:
    """Of the `closest` players of a team that isn't in possession, within the radius of the goal: who is slow in `least` frames or
    more: (match, entity, team, n, first, last). `owner`: (match, frame, owner_team); carry it forward beforehand where it has gaps.

    The goal is `goal`, or, with `sides` as attack_sides() gives them, the middle of the line that the team in possession attacks, in
    frames in which the ball is in that half of the pitch. Until both keepers have been seen the first team by name attacks to the left.
    """
    on = [*match, "frame"]
    p = velocity(points, match=match, **speed).join(owner, on).filter("owner_team <> team").join(ball, on)
    gx, gy = (F.lit(goal[0]), F.lit(goal[1])) if goal is not None else (F.col("_gx"), F.lit(height / 2))
    if goal is None:
        first = owner.groupBy(*match).agg(F.min("owner_team").alias("_first"))
        p = p.join(sides.select(*on, "left_team"), on, "left")
        p = p.join(first, list(match)) if match else p.crossJoin(F.broadcast(first))  # one row
        to_left = F.coalesce(F.col("owner_team") != F.col("left_team"), F.col("owner_team") == F.col("_first"))
        p = p.withColumn("_gx", F.when(to_left, 0.0).otherwise(width)).filter((F.col("bx") < width / 2) == to_left)
    p = p.withColumn("g", distance(F.col("x"), F.col("y"), gx, gy)).filter(F.col("g") <= radius)
    w = Window.partitionBy(*on, "team").orderBy("g", "entity")
    p = p.withColumn("_r", F.row_number().over(w)).filter((F.col("_r") <= closest) & (F.col("speed") < slow))
    out = p.groupBy(*match, "entity", "team").agg(F.count("*").alias("n"), F.min("frame").alias("first"), F.max("frame").alias("last"))
    return out.filter(F.col("n") >= least)


def unpressured_loss(points: DataFrame, ball: DataFrame, runs: DataFrame, radius: float = 100.0, angle: float = 120.0, pad: int = 300, match: tuple = ()) -> DataFrame:
    """Losses of the ball without an opponent about: (match, entity, frame, start, end); the last one for each player.

    At the change, the loser is within the radius of the ball and no player of another team is within the radius and the angle
    (between the ways to the ball and to the opponent).
    """
    on = [*match, "frame"]
    lost = tall.previous(stored(runs, "runs"), list(match), "start", ["team"], ahead=True).filter("next_team <> team").select(*match, "entity", "team", F.col("end").alias("frame"))
    me = lost.join(points.select(*on, "entity", "x", "y"), [*on, "entity"]).join(ball, on)
    me = me.filter(distance(F.col("x"), F.col("y"), F.col("bx"), F.col("by")) <= radius)
    other = points.select(*on, F.col("entity").alias("o_entity"), F.col("team").alias("o_team"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    dx, dy = F.col("ox") - F.col("x"), F.col("oy") - F.col("y")
    pressing = (F.col("o_team") != F.col("team")) & (F.sqrt(dx * dx + dy * dy) <= radius) & (angle_between(F.col("bx") - F.col("x"), F.col("by") - F.col("y"), dx, dy) <= angle)
    pressed = me.join(other, on).filter(pressing).select(*on, "entity").distinct()
    free = me.join(pressed, [*on, "entity"], "left_anti").groupBy(*match, "entity").agg(F.max("frame").alias("frame"))
    return free.select(*match, "entity", "frame", F.greatest(F.col("frame") - pad, F.lit(0)).alias("start"), (F.col("frame") + pad).alias("end"))


def out_of_play(ball: DataFrame, owner: DataFrame, inset: float = 40.0, width: float = 1060.0, height: float = 680.0, reach: int = 10, match: tuple = ()) -> DataFrame:
    """Times in which the ball is outside the inset box, with the last owner in the `reach` frames before: (match, start, end, n, entity).

    `owner`: (match, frame, entity). A run ends when the ball is inside again, or with the data.
    """
    on = [*match, "frame"]
    inside = F.col("bx").between(inset, width - inset) & F.col("by").between(inset, height - inset)
    b = ball.join(owner.select(*on, "entity"), on, "left").withColumn("out", ~inside)
    b = tall.look_back(b, list(match), "frame", "entity", reach, "last")
    b = tall.previous(b, list(match), "frame", ["out"]).withColumn("_c", F.when(F.col("prev_out") == F.col("out"), 0).otherwise(1))
    out = tall.running(b, list(match), "frame", "_c", "_g").filter("out").groupBy(*match, "_g").agg(F.min(F.struct("frame", "last")).alias("a"), F.max("frame").alias("end"), F.count("*").alias("n"))
    return out.filter("a.last IS NOT NULL").select(*match, F.col("a.frame").alias("start"), "end", "n", F.col("a.last").alias("entity"))


def kick_envelopes(kicks: DataFrame, match: tuple = ()) -> DataFrame:
    """(match, entity, n, start, end): the envelope of all times that a player put the ball out of play."""
    return kicks.groupBy(*match, "entity").agg(F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))


def attack_sides(keepers: DataFrame, frames: DataFrame, match: tuple = ()) -> DataFrame:
    """(match, frame, left_team): which team's keeper stood further left when both were last seen; carried on until both are seen again.
    `keepers`: (match, frame, team, x); `frames`: (match, frame)."""
    on = [*match, "frame"]
    seen = keepers.groupBy(*on).agg(F.count_distinct("team").alias("k"), F.min(F.struct("x", "team")).alias("m")).filter("k = 2").select(*on, F.col("m.team").alias("left_team"))
    both = frames.select(*on).distinct().join(seen, on, "left").withColumn("_k", F.floor(F.col("frame") / tall.CHUNK))
    last = both.groupBy(*match, "_k").agg(F.max_by("left_team", F.when(F.col("left_team").isNotNull(), F.col("frame"))).alias("_l"))
    before = Window.partitionBy(*match).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("_l", F.last("_l", True).over(before))
    w = Window.partitionBy(*match, "_k").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    return both.join(last, [*match, "_k"]).select(*on, F.coalesce(F.last("left_team", True).over(w), "_l").alias("left_team"))


def passive_near_ball(points: DataFrame, ball: DataFrame, owner: DataFrame, radius: float = 20.0, slow: float = 1.0, least: int = 60, match: tuple = (), **speed) -> DataFrame:
    """Players of any team not in possession who are slow near the ball: (match, entity, team, n, first, last). `owner`: (match, frame,
    owner_team)."""
    p = with_ball(velocity(points, match=match, **speed), ball, match).join(owner, [*match, "frame"]).filter("owner_team <> team")
    p = p.filter((F.col("dist") <= radius) & (F.col("speed") < slow))
    out = p.groupBy(*match, "entity", "team").agg(F.count("*").alias("n"), F.min("frame").alias("first"), F.max("frame").alias("last"))
    return out.filter(F.col("n") >= least)


def outpaced(points: DataFrame, ball: DataFrame, radius: float = 100.0, difference: float = 3.0, gap: int = 5, least: int = 60, match: tuple = (), **speed) -> DataFrame:
    """The slowest of two or more players of a team near the ball, if the fastest is more than `difference` m/s faster: the longest
    run for each player: (match, entity, start, end, n). Ties go to the earlier run."""
    p = with_ball(velocity(points, match=match, **speed), ball, match).filter((F.col("dist") <= radius) & F.col("speed").isNotNull())
    g = p.groupBy(*match, "frame", "team").agg(F.count("*").alias("k"), F.max("speed").alias("top"), F.min(F.struct("speed", "entity")).alias("slowest"))
    g = g.filter((F.col("k") >= 2) & (F.col("top") - F.col("slowest.speed") > difference)).select(*match, F.col("slowest.entity").alias("entity"), "frame")
    s = tall.spans(g, [*match, "entity"], "frame", gap, least)
    w = Window.partitionBy(*match, "entity").orderBy(F.desc("n"), "start")
    return s.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def delayed_restart(ball: DataFrame, owner: DataFrame, reach: float = 3.0, least: int = 300, match: tuple = (), size: int = scans.SIZE) -> DataFrame:
    """Times in which the ball stays within `reach` of where it was with the same owner: (match, entity, start, end), once a stay.
    `owner`: (match, frame, entity). A match is as many tasks as it has chunks of `size` frames."""
    on = [*match, "frame"]
    return scans.stays(ball.join(owner.select(*on, "entity"), on, "left"), list(match), "frame", "bx", "by", "entity", reach, least, size)
