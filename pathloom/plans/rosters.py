"""Queries of trackers, roster rules by frame, change frames and envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chains, events, roster, tracker
from . import proxies as P
from .catalog import _MATCH, _NEAR, _RUNS, _obs_sql, _points, _query


@_query(_obs_sql("""SELECT run, entity, CASE WHEN f = z THEN z - 1 ELSE f END AS frame FROM (SELECT l.run, l.entity, l."end" AS z, arg_min(p.frame, struct_pack(d := sqrt((p.x - b.bx) * (p.x - b.bx) + (p.y - b.b_y) * (p.y - b.b_y)), f := p.frame)) AS f
 FROM (SELECT * FROM (SELECT *, lead(team) OVER (ORDER BY start) AS nt FROM runs) WHERE nt <> team) l JOIN track p ON p.entity = l.entity AND p.frame BETWEEN greatest(l.start, l."end" - 9) AND l."end" JOIN ball b ON b.frame = p.frame GROUP BY ALL)""", *_MATCH, _NEAR, _RUNS))
def change_frames(spark, d):
    p, b = _points(spark, d)
    return events.change_frames(events.possession_runs(p, b, 60.0, 1), p, b)


@_query(_obs_sql("SELECT f.frame, (SELECT arg_max(l.left_team, l.frame) FROM s l WHERE l.frame <= f.frame) AS left_team FROM (SELECT DISTINCT frame FROM track) f", *_MATCH, "s AS MATERIALIZED (SELECT frame, arg_min(team, struct_pack(x := x, t := team)) AS left_team FROM track WHERE entity % 10 = 0 OR entity % 10 = 3 GROUP BY frame HAVING count(DISTINCT team) = 2)"))
def attack_sides(spark, d):
    p, _ = _points(spark, d)
    return events.attack_sides(p.filter("entity % 10 IN (0, 3)").select("frame", "team", "x"), p.select("frame"))


@_query(_obs_sql("""SELECT entity, count(*) AS n, min(start) AS start, max(z) AS "end" FROM (SELECT min(frame) AS start, max(frame) AS z, arg_min(last, frame) AS entity FROM (SELECT *, sum(c) OVER (ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lag(o) OVER (ORDER BY frame) = o THEN 0 ELSE 1 END AS c FROM (
 SELECT b.frame, NOT (bx BETWEEN 10 AND 480 AND b_y BETWEEN 10 AND 670) AS o, last_value(n.entity IGNORE NULLS) OVER (ORDER BY b.frame RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING) AS last FROM ball b LEFT JOIN near n ON n.frame = b.frame))) WHERE o GROUP BY g HAVING arg_min(CASE WHEN last IS NULL THEN 0 ELSE 1 END, frame) = 1) GROUP BY entity""", *_MATCH, _NEAR))
def kick_envelopes(spark, d):
    p, b = _points(spark, d)
    return events.kick_envelopes(events.out_of_play(b, events.nearest_player(p, b, 60.0), 10.0, 490.0))


# tracks that give way choose in turn; the recursion carries what those before have chosen
@_query("WITH RECURSIVE " + _obs_sql("", P.TRACK)[5:].rstrip() + """, t AS MATERIALIZED (SELECT frame, CAST(team AS VARCHAR) AS team, entity AS track, CAST(entity % 5 AS INTEGER) AS number, x AS conf FROM track),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY frame, team, number ORDER BY conf DESC, track) AS r FROM t),
l AS MATERIALIZED (SELECT team, track, number, row_number() OVER (ORDER BY avg(conf) DESC, track) AS i FROM r GROUP BY team, track, number HAVING max(r) > 1),
taken AS MATERIALIZED (SELECT DISTINCT l.i, o.number AS n FROM l JOIN r a USING (team, track, number) JOIN r o ON o.frame = a.frame AND o.team = a.team AND o.track <> a.track),
tk AS MATERIALIZED (SELECT i, list(n) AS ns FROM taken GROUP BY i),
meet AS MATERIALIZED (SELECT l.i, list(DISTINCT m.i) AS js FROM l JOIN r a USING (team, track, number) JOIN r o ON o.frame = a.frame AND o.team = a.team JOIN l m ON m.team = o.team AND m.track = o.track AND m.number = o.number AND m.i < l.i GROUP BY l.i),
o AS MATERIALIZED (SELECT l.i, list_filter([1, 2, 3, 4, 10, 11, 12, 20, 21, 31, 40], lambda n: contains(CAST(n AS VARCHAR), CAST(l.number AS VARCHAR)) AND n <> l.number AND NOT list_contains(coalesce(tk.ns, []), n)) AS opts, coalesce(meet.js, []) AS js FROM l LEFT JOIN meet USING (i) LEFT JOIN tk USING (i)),
c AS (SELECT 0::BIGINT AS i, []::INTEGER[] AS ch UNION ALL SELECT c.i + 1, list_append(c.ch, list_filter(o.opts, lambda n: NOT list_contains(list_transform(o.js, lambda j: c.ch[j]), n))[1]) FROM c JOIN o ON o.i = c.i + 1),
ch AS MATERIALIZED (SELECT ch FROM c ORDER BY i DESC LIMIT 1)
SELECT t.frame, t.team, t.track, CASE WHEN l.i IS NULL THEN t.number ELSE ch.ch[l.i] END AS number, t.conf, CASE WHEN l.i IS NULL THEN 'kept' WHEN ch.ch[l.i] IS NOT NULL THEN 'changed' ELSE 'unsure' END AS state FROM t LEFT JOIN l USING (team, track, number), ch""")
def track_numbers(spark, d):
    t = P.track(P.obs(spark, d)).select("frame", F.col("team").cast("string").alias("team"), F.col("entity").alias("track"), (F.col("entity") % 5).cast("int").alias("number"), F.col("x").alias("conf"))
    numbers = F.array(*map(F.lit, (1, 2, 3, 4, 10, 11, 12, 20, 21, 31, 40)))
    return roster.resolve_in_frames(t, t.select("team").distinct().withColumn("numbers", numbers))


def _boxes(spark, d):
    o = P.obs(spark, d)
    return o.select("event_id", "team", "frame", "x", "y", (F.col("x") / 500).alias("conf"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + 60).alias("x2"), (F.col("y") + 60).alias("y2"))


@_query()
def box_tracks(spark, d):
    return tracker.track(_boxes(spark, d), ["team"], chunk=200).select("event_id", "track")


@_query(_obs_sql("""SELECT event_id FROM (SELECT o.event_id, row_number() OVER (PARTITION BY o.team, o.frame ORDER BY sqrt((o.x - g.cx) * (o.x - g.cx) + (o.y - g.cy) * (o.y - g.cy)), o.x, o.y) AS r FROM obs o JOIN (
 SELECT team, frame, sum(sx) OVER w / sum(n) OVER w AS cx, sum(sy) OVER w / sum(n) OVER w AS cy FROM (SELECT team, frame, sum(x) AS sx, sum(y) AS sy, count(*) AS n FROM obs GROUP BY team, frame) WINDOW w AS (PARTITION BY team ORDER BY frame ROWS 9 PRECEDING)) g ON g.team = o.team AND g.frame = o.frame) WHERE r = 1"""))
def nearest_to_recent(spark, d):
    return tracker.nearest_to_recent(_boxes(spark, d).select("event_id", "team", "frame", "x", "y"), ["team"], "frame", then=("event_id",)).select("event_id")


@_query(_obs_sql("""SELECT entity, clip, rn AS frame FROM (WITH RECURSIVE o AS MATERIALIZED (SELECT entity, rn, role = 'error' AS t FROM obs),
st AS (SELECT entity, 0::BIGINT AS rn, 0::BIGINT AS clip, 0::BIGINT AS l, 0::BIGINT AS w, 0::BIGINT AS held FROM o WHERE rn = 1 UNION ALL
 SELECT o.entity, o.rn, CASE WHEN t AND w = 0 THEN clip + 1 ELSE clip END, CASE WHEN t AND w = 0 THEN 2 WHEN l > 0 THEN l - 1 ELSE 0 END, CASE WHEN t AND w = 0 THEN 9 ELSE greatest(w - 1, 0) END, CASE WHEN t AND w = 0 THEN 0 WHEN l > 0 THEN held ELSE least(held + 1, 4) END FROM st JOIN o ON o.entity = st.entity AND o.rn = st.rn + 1),
x AS MATERIALIZED (SELECT *, lag(clip) OVER (PARTITION BY entity ORDER BY rn) AS pc, lag(l) OVER (PARTITION BY entity ORDER BY rn) AS pl, lag(held) OVER (PARTITION BY entity ORDER BY rn) AS ph FROM st)
SELECT entity, clip, rn FROM x WHERE rn > 0 AND (clip <> pc OR pl > 0) UNION ALL SELECT entity, clip, unnest(range(rn - ph, rn)) AS rn FROM x WHERE rn > 0 AND clip <> pc)"""))
def ring_clips(spark, d):
    o = P.obs(spark, d).withColumn("t", F.col("role") == "error")
    return tracker.ring_clips(o, ["entity"], "rn", "t", 4, 3, 10)


@_query()
def relabel_in_turn(spark, d):
    s = P.seg(spark, d).select(F.col("entity").cast("string").alias("team"), F.col("id").alias("track"), (F.col("conf") / 1e6).alias("conf"), "start", "end")
    w = s.groupBy("team", F.floor(F.col("start") / 400).alias("k")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), F.collect_set("track").alias("members")).drop("k")
    return roster.relabel_in_turn(s, w.withColumn("n", F.col("n") + 8), 0.1).select("team", "track", "relabelled")


@_query()
def split_tracks(spark, d):
    o = P.obs(spark, d).select("event_id", "entity", "rn", "role", "x", "y")
    return chains.split_tracks(o, ["entity"], "rn", "role", 5, 0.6, 3, 490.0, 99.0).select("event_id", "piece")


@_query()
def stitched_points(spark, d):
    p = P.track(P.obs(spark, d)).withColumn("piece", F.col("entity") * 1_000_000 + F.floor(F.col("frame") / 100)).withColumn("conf", F.col("x") / 500)
    return chains.stitch_points(p.select("team", "piece", "frame", "x", "y", "conf"), ["team"], "piece", "frame", 11, 3)


@_query()
def smooth_ball(spark, d):
    o = P.obs(spark, d).select("entity", "rn", "x", "y")
    return chains.smooth_ball(o, ["entity"], "rn", 20.0, 60.0, 5, {"window": 41, "step": 20, "prominence": 20.0})


@_query()
def ball_path(spark, d):
    o = P.obs(spark, d).select("entity", "rn", "x", "y")
    return chains.ball_path(o, ["entity"], "rn", {"eps": 20.0, "extent": 20.0}, {"window": 41, "step": 20, "prominence": 20.0}, residual=40.0, least=8, apart=5)


# the filter's place, speed and covariance (a, b, d of an axis) go from frame to frame of a day
@_query("WITH RECURSIVE " + _obs_sql("")[5:].rstrip() + """, c AS MATERIALIZED (SELECT event_id, team, frame // 24 AS day, frame, x, y, dense_rank() OVER (PARTITION BY team, frame // 24 ORDER BY frame) AS i FROM obs),
k AS MATERIALIZED (SELECT c.event_id, c.team, c.day, c.i, c.x, c.y, count(o.event_id) AS stood FROM c LEFT JOIN c o ON o.team = c.team AND o.day = c.day AND o.frame BETWEEN c.frame - 5 AND c.frame - 1 AND sqrt((o.x - c.x) * (o.x - c.x) + (o.y - c.y) * (o.y - c.y)) < 5 GROUP BY ALL),
st AS (SELECT team, day, i, p.x AS x, p.y AS y, 0.0::DOUBLE AS vx, 0.0::DOUBLE AS vy, 100.0::DOUBLE AS a, 0.0::DOUBLE AS b, 100.0::DOUBLE AS d, p.x AS lx, p.y AS ly, p.id AS id
  FROM (SELECT team, day, i, arg_min(struct_pack(x := x, y := y, id := event_id), struct_pack(f := sqrt((x - 530) * (x - 530) + (y - 330) * (y - 330)), x := x, y := y)) AS p FROM k WHERE i = 1 GROUP BY team, day, i) UNION ALL
 SELECT team, day, i, CASE WHEN ok THEN x + vx + g0 * (p.x - x - vx) ELSE x END, CASE WHEN ok THEN y + vy + g0 * (p.y - y - vy) ELSE y END, CASE WHEN ok THEN vx + g1 * (p.x - x - vx) ELSE vx END, CASE WHEN ok THEN vy + g1 * (p.y - y - vy) ELSE vy END,
  CASE WHEN ok THEN pa - g0 * pa ELSE a END, CASE WHEN ok THEN pb - g0 * pb ELSE b END, CASE WHEN ok THEN d + 10 - g1 * pb ELSE d END, CASE WHEN ok THEN p.x ELSE lx END, CASE WHEN ok THEN p.y ELSE ly END, CASE WHEN ok THEN p.id END
  FROM (SELECT *, n > 1 OR sqrt((p.x - lx) * (p.x - lx) + (p.y - ly) * (p.y - ly)) <= 150 AS ok, pa / (pa + 50) AS g0, pb / (pa + 50) AS g1 FROM (
   SELECT k.team, k.day, k.i, st.x, st.y, st.vx, st.vy, st.a, st.b, st.d, st.lx, st.ly, count(*) AS n, st.a + 2 * st.b + st.d + 10 AS pa, st.b + st.d AS pb, arg_min(struct_pack(x := k.x, y := k.y, id := k.event_id), struct_pack(cost := sqrt((k.x - st.x - st.vx) * (k.x - st.x - st.vx) + (k.y - st.y - st.vy) * (k.y - st.y - st.vy)) + 50 * k.stood
     + CASE WHEN sqrt((k.x - st.lx) * (k.x - st.lx) + (k.y - st.ly) * (k.y - st.ly)) > 150 THEN 1000 ELSE sqrt((k.x - st.lx) * (k.x - st.lx) + (k.y - st.ly) * (k.y - st.ly)) END, x := k.x, y := k.y)) AS p
   FROM st JOIN k ON k.team = st.team AND k.day = st.day AND k.i = st.i + 1 GROUP BY k.team, k.day, k.i, st.x, st.y, st.vx, st.vy, st.a, st.b, st.d, st.lx, st.ly)))
SELECT id AS event_id FROM st WHERE id IS NOT NULL""")
def pick_ball(spark, d):
    b = _boxes(spark, d).select("event_id", "team", F.expr("frame div 24").alias("day"), "frame", "x", "y")
    return chains.pick_ball(b, ["team", "day"], "frame").select("event_id")


@_query(_obs_sql("""SELECT event_id FROM (SELECT event_id, floor(x / 5) AS cx, floor(y / 5) AS cy FROM b) o WHERE NOT EXISTS (SELECT 1 FROM dense q WHERE q.cx = o.cx AND q.cy = o.cy)""", "b AS (SELECT * FROM obs WHERE x BETWEEN 0 AND 400 AND y BETWEEN 0 AND 90)", "c AS (SELECT floor(x / 5) AS cx, floor(y / 5) AS cy, count(*) AS n FROM b GROUP BY ALL)",
"dense AS (SELECT c.cx, c.cy FROM c WHERE n >= 10 OR (n >= 6 AND EXISTS (SELECT 1 FROM c p WHERE p.n >= 10 AND abs(p.cx - c.cx) <= 2 AND abs(p.cy - c.cy) <= 2 AND ((p.cx - c.cx) * (p.cx - c.cx) + (p.cy - c.cy) * (p.cy - c.cy)) * 25 <= 100)))"))
def static_free_ball(spark, d):
    return chains.static_free_ball(P.obs(spark, d), 400.0, 90.0, 5.0, 10, 6, 10.0).select("event_id")


@_query()
def anchor_sizes(spark, d):
    return chains.anchors(P.box(spark, d).select((F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h")))
