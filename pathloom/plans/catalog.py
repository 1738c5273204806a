"""The queries over the driver's tables, each with its DuckDB equivalent."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import geometry as G
from ..functions import labels as L
from ..functions import times as T
from ..operators import boxes, events, joins, scans, stats, tall, vectors
from . import proxies as P

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None, *, name: str | None = None):
    def keep(f):
        _QUERIES[name or f.__name__] = f
        if sql:
            _SQL[name or f.__name__] = sql
        return f

    return keep


def _obs_sql(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([P.OBS, *more]) + "\n" + body


def _points(spark, d):
    """Tracks and ball in a plane of 490 by 99 units."""
    o = P.obs(spark, d)
    return P.track(o).select("entity", "team", "frame", "x", "y"), P.ball(o)


@_query("SELECT entity, frame, x, y FROM obs WHERE x BETWEEN 0 AND 400 AND role <> 'error' AND frame % 2 = 0".join(["WITH " + P.OBS + "\n", ""]))
def scan_project_filter(spark, d):
    return P.obs(spark, d).filter(G.in_bounds(F.col("x"), F.col("y"), 400.0, 1e9) & (F.col("role") != "error") & (F.col("frame") % 2 == 0)).select("entity", "frame", "x", "y")


@_query("SELECT event_id, CAST(regexp_extract(props, '(-?\\d+)', 1) AS INTEGER) AS k, value IS NOT NULL AND NOT isnan(value) AS valid FROM events")
def json_extract_types(spark, d):
    e = P.table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", L.number_or(k).alias("k"), L.valid_number(F.col("value")).alias("valid"))


@_query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(v AS DOUBLE) AS v FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def explode_arrays(spark, d):
    e = P.table(spark, d, "embeddings")
    return tall.arrays_to_rows(e.select("vec_id", F.col("embedding").alias("v")), ["v"], ["vec_id"], "pos").withColumn("v", F.col("v").cast("double"))


@_query(_obs_sql("SELECT entity, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY rn) AS ids, count(*) AS n FROM obs GROUP BY entity"))
def regroup_arrays(spark, d):
    r = tall.rows_to_arrays(P.obs(spark, d), ["entity"], "rn", ["event_id"])
    return r.select("entity", F.array_join(F.transform("event_id", lambda v: v.cast("string")), ",").alias("ids"), F.size("rn").cast("long").alias("n"))


_SPEED = """s AS (SELECT entity, rn, sqrt(dx * dx + dy * dy) * 0.1::DOUBLE AS metres, dt FROM (
  SELECT entity, rn, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, (frame - lag(frame) OVER w) / 29.97::DOUBLE AS dt FROM obs WHERE (rn - 1) % 5 = 0 WINDOW w AS (PARTITION BY entity ORDER BY rn)) WHERE dx IS NOT NULL),
v AS (SELECT *, CASE WHEN dt > 0 THEN metres / dt * 3.6::DOUBLE END AS kmh FROM s)"""


@_query(_obs_sql("SELECT entity, count(*) AS n, round(sum(metres), 4) AS metres, round(avg(kmh), 4) AS mean_kmh, round(max(kmh), 4) AS max_kmh, round(quantile_cont(kmh, 0.1), 4) AS p10_kmh FROM v GROUP BY entity", _SPEED))
def interval_speed_stats(spark, d):
    s = stats.speed_statistics(P.obs(spark, d), ["entity"])
    return s.select("entity", "n", *[F.round(c, 4).alias(c) for c in ("metres", "mean_kmh", "max_kmh", "p10_kmh")])


@_query(_obs_sql("""SELECT entity, count(*) AS n, CASE WHEN count(*) >= 4 AND avg(CASE WHEN i <= floor(n * 0.5::DOUBLE) THEN kmh END) > 0 THEN round(avg(CASE WHEN i > floor(n * 0.5::DOUBLE) THEN kmh END) / avg(CASE WHEN i <= floor(n * 0.5::DOUBLE) THEN kmh END), 4) END AS speed_ratio,
CASE WHEN count(*) >= 4 AND avg(CASE WHEN i <= floor(n * 0.5::DOUBLE) THEN metres END) > 0 THEN round(avg(CASE WHEN i > floor(n * 0.5::DOUBLE) THEN metres END) / avg(CASE WHEN i <= floor(n * 0.5::DOUBLE) THEN metres END), 4) END AS distance_ratio
FROM (SELECT *, count(*) OVER (PARTITION BY entity) AS n, row_number() OVER (PARTITION BY entity ORDER BY rn) AS i FROM v) GROUP BY entity""", _SPEED))
def split_ratio_stats(spark, d):
    s = stats.split_ratios(P.obs(spark, d), ["entity"])
    return s.select("entity", "n", F.round("speed_ratio", 4).alias("speed_ratio"), F.round("distance_ratio", 4).alias("distance_ratio"))


@_query(_obs_sql("SELECT entity, role, score FROM (SELECT entity, role, sum(CAST(y AS BIGINT)) AS score FROM obs GROUP BY entity, role) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY score DESC, role) = 1"))
def team_vote(spark, d):
    return stats.weighted_vote(P.obs(spark, d), ["entity"], "role", F.col("y").cast("long"))


@_query(_obs_sql("""SELECT e.entity, CASE WHEN c.n >= 5 AND c.total >= 5 THEN c.digit END AS digit, coalesce(c.n, 0) AS n, coalesce(c.total, 0) AS total, CASE WHEN c.n IS NULL THEN 'N/A' WHEN c.n >= 5 AND c.total >= 5 THEN 'known' ELSE 'unsure' END AS state
FROM (SELECT DISTINCT entity FROM obs) e LEFT JOIN (SELECT *, CAST(sum(n) OVER (PARTITION BY entity) AS BIGINT) AS total FROM (SELECT entity, CAST(y AS BIGINT) % 5 AS digit, count(*) AS n FROM obs WHERE x >= 300 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY n DESC, digit) = 1) c USING (entity)"""))
def majority_with_threshold(spark, d):
    o = P.obs(spark, d).withColumn("digit", F.col("y").cast("long") % 5)
    return stats.majority(o, ["entity"], "digit", F.col("x") >= 300, 5)


_CELLS = "cells AS (SELECT team, CAST(greatest(0, least(floor((x - 0) / (490.0::DOUBLE / 49)), 48)) AS INTEGER) AS cell_x, CAST(greatest(0, least(floor((y - 0) / (100.0::DOUBLE / 20)), 19)) AS INTEGER) AS cell_y, count(*) AS n FROM obs GROUP BY ALL)"


def _cells(spark, d):
    return stats.heat_bins(P.obs(spark, d), ["team"], 490.0, 100.0, 49, 20)


@_query(_obs_sql("SELECT * FROM cells", _CELLS))
def heat_bins(spark, d):
    return _cells(spark, d)


def _blur_sql() -> str:
    k = stats.gaussian_kernel()
    r = len(k) // 2
    kernel = "k AS (SELECT * FROM (VALUES " + ", ".join(f"({i - r}, {w!r}::DOUBLE)" for i, w in enumerate(k)) + ") t(d, w))"
    fold = lambda v, n: f"CASE WHEN {v} < 0 THEN -{v} - 1 WHEN {v} >= {n} THEN {2 * n - 1} - {v} ELSE {v} END"
    return _obs_sql(
        f"SELECT team, CAST(cell_x AS INTEGER) AS cell_x, CAST({fold('(cell_y + d)', 20)} AS INTEGER) AS cell_y, round(sum(v * w), 5) AS v FROM (SELECT team, {fold('(cell_x + d)', 49)} AS cell_x, cell_y, sum(n * w) AS v FROM cells, k GROUP BY ALL) h, k GROUP BY ALL",
        _CELLS, kernel,
    )


@_query(_blur_sql())
def heat_blur(spark, d):
    out = stats.blur(_cells(spark, d), ["team"], 49, 20, stats.gaussian_kernel())
    return out.select("team", F.col("cell_x").cast("int"), F.col("cell_y").cast("int"), F.round("v", 5).alias("v"))


@_query(_obs_sql("""SELECT event_id FROM (SELECT event_id, floor(x / 5) AS cx, floor(y / 5) AS cy FROM obs) o WHERE NOT EXISTS (SELECT 1 FROM dense q WHERE q.cx = o.cx AND q.cy = o.cy)""",
"c AS (SELECT floor(x / 5) AS cx, floor(y / 5) AS cy, count(*) AS n FROM obs GROUP BY ALL)",
"dense AS (SELECT c.cx, c.cy FROM c WHERE n >= 10 OR (n >= 6 AND EXISTS (SELECT 1 FROM c p WHERE p.n >= 10 AND abs(p.cx - c.cx) <= 2 AND abs(p.cy - c.cy) <= 2 AND ((p.cx - c.cx) * (p.cx - c.cx) + (p.cy - c.cy) * (p.cy - c.cy)) * 25 <= 100)))"))
def density_filter(spark, d):
    return stats.without_dense(P.obs(spark, d), 5.0, 10, 6, 10.0).select("event_id")


@_query(_obs_sql("SELECT entity, count(*) AS n FROM obs GROUP BY entity HAVING avg(CASE WHEN least(x, y, 490 - x, 99 - y) < 12 THEN 1.0 ELSE 0.0 END) < 0.4"))
def boundary_filter(spark, d):
    near = G.near_edge(F.col("x"), F.col("y"), 12.0, 490.0, 99.0)
    return P.obs(spark, d).groupBy("entity").agg(F.count("*").alias("n"), F.avg(near.cast("int")).alias("s")).filter("s < 0.4").select("entity", "n")


@_query(_obs_sql("SELECT entity, count(*) AS n, round(coalesce(sum(dd), 0), 4) AS length FROM (SELECT entity, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS dd FROM obs WINDOW w AS (PARTITION BY entity ORDER BY rn)) GROUP BY entity HAVING count(*) >= 2 AND sum(dd) >= 6000"))
def path_length_filter(spark, d):
    p = stats.path_length(P.obs(spark, d), ["entity"], "rn")
    return p.filter("n >= 2 AND length >= 6000").select("entity", "n", F.round("length", 4).alias("length"))


@_query(_obs_sql("SELECT frame, count(*) AS n FROM obs WHERE role = 'purchase' GROUP BY frame HAVING count(*) > 1"))
def multi_ball_frames(spark, d):
    return P.obs(spark, d).filter("role = 'purchase'").groupBy("frame").agg(F.count("*").alias("n")).filter("n > 1")


_VIOLATIONS = "viol AS (SELECT frame, role, count(DISTINCT entity) AS n FROM obs GROUP BY frame, role HAVING count(DISTINCT entity) > CASE WHEN role = 'error' THEN 2 ELSE 4 END)"


def _violations(spark, d):
    return stats.size_violations(P.obs(spark, d), "frame", "role", "entity", F.when(F.col("role") == "error", 2).otherwise(4))


@_query(_obs_sql("SELECT v.frame, v.role, v.n, (SELECT string_agg(e, ',' ORDER BY k) FROM (SELECT DISTINCT entity AS k, CAST(entity AS VARCHAR) AS e FROM obs o WHERE o.frame = v.frame AND o.role = v.role)) AS members FROM viol v", _VIOLATIONS))
def team_size_violations(spark, d):
    return _violations(spark, d).withColumn("members", F.array_join(F.transform("members", lambda v: v.cast("string")), ","))


@_query(_obs_sql("""SELECT role, n, min(frame) AS start, max(frame) AS "end", count(DISTINCT frame) AS frames, count(DISTINCT entity) AS members FROM (
 SELECT i.role, i.n, i.g, i.frame, o.entity FROM (SELECT *, sum(new) OVER (PARTITION BY role, n ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN frame - lag(frame) OVER (PARTITION BY role, n ORDER BY frame) <= 3 THEN 0 ELSE 1 END AS new FROM viol)) i JOIN obs o ON o.frame = i.frame AND o.role = i.role) GROUP BY role, n, g""", _VIOLATIONS))
def violation_windows(spark, d):
    v = tall.islands(_violations(spark, d), ["role", "n"], "frame", 3)
    g = v.groupBy("role", "n", "island").agg(F.min("frame").alias("start"), F.max("frame").alias("end"), F.count_distinct("frame").alias("frames"), F.size(F.array_distinct(F.flatten(F.collect_list("members")))).cast("long").alias("members"))
    return g.drop("island")


_NEAR = """near AS (SELECT t.frame, t.entity, t.team, sqrt((x - bx) * (x - bx) + (y - b_y) * (y - b_y)) AS dist FROM track t JOIN ball USING (frame) WHERE sqrt((x - bx) * (x - bx) + (y - b_y) * (y - b_y)) <= 60
  QUALIFY row_number() OVER (PARTITION BY t.frame ORDER BY sqrt((x - bx) * (x - bx) + (y - b_y) * (y - b_y)), t.entity) = 1)"""
_RUNS = """elig AS (SELECT DISTINCT frame FROM track WHERE frame IN (SELECT frame FROM ball)),
own AS (SELECT e.frame, n.entity, n.team FROM elig e LEFT JOIN near n ON n.frame = e.frame),
runs AS (SELECT run, entity, team, min(frame) AS start, max(frame) AS "end", count(*) AS n FROM (SELECT *, sum(c) OVER (ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM (
  SELECT *, CASE WHEN lag(entity) OVER (ORDER BY frame) IS NOT DISTINCT FROM entity AND row_number() OVER (ORDER BY frame) > 1 THEN 0 ELSE 1 END AS c FROM own)) WHERE entity IS NOT NULL GROUP BY run, entity, team)"""
_MATCH = (P.TRACK, P.BALL)


@_query(_obs_sql("SELECT frame, entity, team, dist FROM near", *_MATCH, _NEAR))
def nearest_in_frame(spark, d):
    return events.nearest_player(*_points(spark, d), 60.0)


@_query(_obs_sql('SELECT run, entity, team, start, "end", n FROM runs WHERE n >= 1', *_MATCH, _NEAR, _RUNS))
def possession_runs(spark, d):
    return events.possession_runs(*_points(spark, d), 60.0, 1)


@_query(_obs_sql("SELECT team, entity, CAST(sum(n) AS BIGINT) AS frames, round(sum(n) / CAST(sum(sum(n)) OVER () AS DOUBLE), 6) AS share FROM runs GROUP BY team, entity", *_MATCH, _NEAR, _RUNS))
def possession_share(spark, d):
    s = events.possession_share(events.possession_runs(*_points(spark, d), 60.0, 1))
    return s.withColumn("share", F.round("share", 6))


@_query(_obs_sql('SELECT entity, count(*) AS n, arg_min(start, start) AS start, arg_min("end", start) AS "end" FROM runs GROUP BY entity HAVING count(*) > 2', *_MATCH, _NEAR, _RUNS))
def turnovers(spark, d):
    return events.turnovers(events.possession_runs(*_points(spark, d), 60.0, 1), 2)


@_query(_obs_sql("SELECT run, start, entity, team, lost_by, lost_team FROM (SELECT *, lag(entity) OVER (ORDER BY start) AS lost_by, lag(team) OVER (ORDER BY start) AS lost_team FROM runs) WHERE lost_team <> team", *_MATCH, _NEAR, _RUNS))
def possession_change_frames(spark, d):
    return events.possession_changes(events.possession_runs(*_points(spark, d), 60.0, 1))


_STEPS = """st AS (SELECT *, sqrt((x - bx) * (x - bx) + (y - b_y) * (y - b_y)) AS dist, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, bx - lag(bx) OVER w AS bdx, b_y - lag(b_y) OVER w AS bdy
  FROM track JOIN ball USING (frame) WINDOW w AS (PARTITION BY entity ORDER BY frame))"""


@_query(_obs_sql("""SELECT entity, valid, abnormal, first, last FROM (SELECT entity, count(*) AS valid, count(*) FILTER (bad) AS abnormal, min(frame) FILTER (bad) AS first, max(frame) FILTER (bad) AS last, arg_max(dist, frame) FILTER (bad) - arg_min(dist, frame) FILTER (bad) AS growth FROM (
 SELECT *, degrees(acos(greatest(-1.0, least(1.0, (dx * bdx + dy * bdy) / (sqrt(dx * dx + dy * dy) * sqrt(bdx * bdx + bdy * bdy)))))) > 120 AS bad FROM st WHERE dist <= 200 AND sqrt(dx * dx + dy * dy) >= 0.01 AND sqrt(bdx * bdx + bdy * bdy) >= 0.01) GROUP BY entity)
 WHERE valid >= 5 AND abnormal >= 3 AND abnormal > 0.1::DOUBLE * valid AND growth > 5""", *_MATCH, _STEPS))
def opposite_direction(spark, d):
    return events.opposite_direction(*_points(spark, d), share=0.1, growth=5.0)


@_query(_obs_sql("""SELECT entity, n, first, last FROM (SELECT entity, count(*) AS n, min(frame) AS first, max(frame) AS last, arg_max(dist, frame) - arg_min(dist, frame) AS growth FROM st
 WHERE dist <= 200 AND sqrt(dx * dx + dy * dy) <= 40 AND sqrt(bdx * bdx + bdy * bdy) >= 0.01 GROUP BY entity) WHERE n >= 1 AND growth > 0.5""", *_MATCH, _STEPS))
def stationary(spark, d):
    return events.stationary(*_points(spark, d), radius=200.0, still=40.0)


_SPEEDS = """sp AS (SELECT *, CASE WHEN frame - pf <= 24 THEN sqrt((x - px) * (x - px) + (y - py) * (y - py)) * 30.0::DOUBLE * 0.1::DOUBLE / (frame - pf) END AS speed FROM (
  SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(frame) OVER w AS pf FROM track WINDOW w AS (PARTITION BY entity ORDER BY frame)))"""


def _owner(spark, d):
    p, b = _points(spark, d)
    return events.nearest_player(p, b, 60.0).select("frame", F.col("team").alias("owner_team"))


@_query(_obs_sql("""SELECT entity, team, count(*) AS n, min(frame) AS first, max(frame) AS last FROM (SELECT s.entity, s.team, s.frame, s.speed FROM sp s JOIN near o ON o.frame = s.frame AND o.team <> s.team JOIN ball b ON b.frame = s.frame
 WHERE sqrt((s.x - 0.0) * (s.x - 0.0) + (s.y - 50.0) * (s.y - 50.0)) <= 300 QUALIFY row_number() OVER (PARTITION BY s.frame, s.team ORDER BY sqrt((s.x - 0.0) * (s.x - 0.0) + (s.y - 50.0) * (s.y - 50.0)), s.entity) <= 3) WHERE speed < 50 GROUP BY entity, team HAVING count(*) >= 2""", *_MATCH, _NEAR, _SPEEDS))
def slow_near_goal(spark, d):
    return events.slow_near_goal(*_points(spark, d), _owner(spark, d), (0.0, 50.0), 300.0, slow=50.0, least=2, most_gap=24)


@_query(_obs_sql("""SELECT entity, team, count(*) AS n, min(frame) AS first, max(frame) AS last FROM (SELECT s.* FROM sp s JOIN near o ON o.frame = s.frame AND o.team <> s.team JOIN ball b ON b.frame = s.frame WHERE sqrt((s.x - bx) * (s.x - bx) + (s.y - b_y) * (s.y - b_y)) <= 150 AND speed < 60) GROUP BY entity, team HAVING count(*) >= 2""", *_MATCH, _NEAR, _SPEEDS))
def passive_near_ball(spark, d):
    return events.passive_near_ball(*_points(spark, d), _owner(spark, d), radius=150.0, slow=60.0, least=2, most_gap=24)


@_query(_obs_sql("""SELECT entity, start, "end", n FROM (SELECT entity, min(frame) AS start, max(frame) AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY entity ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM (
 SELECT *, CASE WHEN frame - lag(frame) OVER (PARTITION BY entity ORDER BY frame) <= 48 THEN 0 ELSE 1 END AS new FROM (SELECT frame, arg_min(entity, struct_pack(s := speed, e := entity)) AS entity FROM sp JOIN ball USING (frame)
 WHERE speed IS NOT NULL AND sqrt((x - bx) * (x - bx) + (y - b_y) * (y - b_y)) <= 300 GROUP BY frame, team HAVING count(*) >= 2 AND max(speed) - min(speed) > 3))) GROUP BY entity, g) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY n DESC, start) = 1""", *_MATCH, _SPEEDS))
def outpaced(spark, d):
    return events.outpaced(*_points(spark, d), radius=300.0, gap=48, least=1, most_gap=24)


@_query(_obs_sql("""SELECT entity, max(frame) AS frame, greatest(max(frame) - 300, 0) AS start, max(frame) + 300 AS "end" FROM (SELECT l.entity, l.frame FROM (SELECT entity, team, "end" AS frame FROM (SELECT *, lead(team) OVER (ORDER BY start) AS nt FROM runs) WHERE nt <> team) l
 JOIN track p ON p.entity = l.entity AND p.frame = l.frame JOIN ball b ON b.frame = l.frame WHERE sqrt((p.x - bx) * (p.x - bx) + (p.y - b_y) * (p.y - b_y)) <= 100
 AND NOT EXISTS (SELECT 1 FROM track o WHERE o.frame = l.frame AND o.team <> l.team AND sqrt((o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y)) <= 100 AND
 CASE WHEN sqrt((bx - p.x) * (bx - p.x) + (b_y - p.y) * (b_y - p.y)) * sqrt((o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y)) = 0 THEN 0 ELSE degrees(acos(greatest(-1.0, least(1.0, ((bx - p.x) * (o.x - p.x) + (b_y - p.y) * (o.y - p.y)) / (sqrt((bx - p.x) * (bx - p.x) + (b_y - p.y) * (b_y - p.y)) * sqrt((o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y))))))) END <= 120)) GROUP BY entity""", *_MATCH, _NEAR, _RUNS))
def unpressured_loss(spark, d):
    p, b = _points(spark, d)
    return events.unpressured_loss(p, b, events.possession_runs(p, b, 60.0, 1))


@_query(_obs_sql("""SELECT min(frame) AS start, max(frame) AS "end", count(*) AS n, arg_min(last, frame) AS entity FROM (SELECT *, sum(c) OVER (ORDER BY frame ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lag(o) OVER (ORDER BY frame) = o THEN 0 ELSE 1 END AS c FROM (
 SELECT b.frame, NOT (bx BETWEEN 40 AND 450 AND b_y BETWEEN 10 AND 89) AS o, last_value(n.entity IGNORE NULLS) OVER (ORDER BY b.frame RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING) AS last FROM ball b LEFT JOIN near n ON n.frame = b.frame))) WHERE o GROUP BY g HAVING arg_min(CASE WHEN last IS NULL THEN 0 ELSE 1 END, frame) = 1""", *_MATCH, _NEAR))
def out_of_play(spark, d):
    p, b = _points(spark, d)
    inside = b.withColumn("by", F.when(F.col("by").between(10, 89), 100.0).otherwise(-1.0))
    return events.out_of_play(inside, events.nearest_player(p, b, 60.0), 40.0, 490.0, 1000.0)


@_query("WITH RECURSIVE " + _obs_sql("", *_MATCH, _NEAR.replace("<= 60", "<= 200"))[5:].rstrip() + """, b AS MATERIALIZED (SELECT row_number() OVER (ORDER BY frame) AS i, frame, bx, b_y, coalesce(near.entity, -1) AS e FROM ball LEFT JOIN near USING (frame)),
st AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS f, NULL::DOUBLE AS x, NULL::DOUBLE AS y, NULL::BIGINT AS e, 0::BIGINT AS n, NULL::BIGINT AS oe, NULL::BIGINT AS os, NULL::BIGINT AS oz UNION ALL
 SELECT i, CASE WHEN s AND n >= 1 THEN NULL WHEN s THEN f ELSE frame END, CASE WHEN s AND n >= 1 THEN NULL WHEN s THEN x ELSE bx END, CASE WHEN s AND n >= 1 THEN NULL WHEN s THEN y ELSE b_y END, CASE WHEN s AND n >= 1 THEN NULL WHEN s THEN e ELSE be END, CASE WHEN s AND n >= 1 THEN 0 WHEN s THEN n + 1 ELSE 1 END,
  CASE WHEN s AND n >= 1 THEN e END, CASE WHEN s AND n >= 1 THEN f END, CASE WHEN s AND n >= 1 THEN frame END FROM (SELECT b.i, b.frame, b.bx, b.b_y, b.e AS be, st.f, st.x, st.y, st.e, st.n, coalesce(sqrt((b.bx - st.x) * (b.bx - st.x) + (b.b_y - st.y) * (b.b_y - st.y)) <= 150 AND b.e = st.e AND st.e >= 0, false) AS s FROM st JOIN b ON b.i = st.i + 1))
SELECT oe AS entity, os AS start, oz AS "end" FROM st WHERE oe IS NOT NULL""")
def delayed_restart(spark, d):
    p, b = _points(spark, d)
    return events.delayed_restart(b, events.nearest_player(p, b, 200.0), 150.0, 2)


@_query(_obs_sql("""SELECT entity, f AS frame, CASE WHEN f = frame THEN x ELSE x + (nx - x) * ((f - frame) / CAST(nf - frame AS DOUBLE)) END AS x FROM (
 SELECT entity, frame, x, lead(x) OVER w AS nx, lead(frame) OVER w AS nf, unnest(range(frame, coalesce(lead(frame) OVER w, frame + 1))) AS f FROM track WINDOW w AS (PARTITION BY entity ORDER BY frame))""", P.TRACK))
def interpolate_frames(spark, d):
    p, _ = _points(spark, d)
    return tall.interpolate(p, ["entity"], "frame", ["x"]).select("entity", "frame", "x")


_FILLED = """fl AS (SELECT entity, rn, x, x > 150 OR coalesce((min(i) FILTER (on_) OVER (PARTITION BY entity ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - (max(i) FILTER (on_) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING)) - 1 <= 2, false) AS filled FROM (SELECT *, rn AS i, x > 150 AS on_ FROM obs))"""


@_query(_obs_sql("""SELECT entity, min(rn) AS start, max(rn) AS "end", count(*) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lag(filled) OVER (PARTITION BY entity ORDER BY rn) = filled THEN 0 ELSE 1 END AS c FROM fl)) WHERE filled GROUP BY entity, g""", _FILLED))
def mask_runs(spark, d):
    o = tall.fill_gaps(P.obs(spark, d).withColumn("on", F.col("x") > 150), ["entity"], "rn", "on", 2)
    return tall.runs(o, ["entity"], "rn", "filled").filter("filled").select("entity", "start", "end", "n")


@_query(_obs_sql("""SELECT event_id, round(CASE WHEN on_ AND n > 1 THEN a + (b - a) * i / (n - 1) ELSE x END, 6) AS x FROM (SELECT *, first_value(x) OVER (PARTITION BY entity, g ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS a, last_value(x) OVER (PARTITION BY entity, g ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS b,
 count(*) OVER (PARTITION BY entity, g) AS n, row_number() OVER (PARTITION BY entity, g ORDER BY rn) - 1 AS i FROM (SELECT *, sum(c) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, x > 300 AS on_, CASE WHEN lag(x > 300) OVER (PARTITION BY entity ORDER BY rn) = (x > 300) THEN 0 ELSE 1 END AS c FROM obs)))"""))
def linear_bridge(spark, d):
    return tall.bridge(P.obs(spark, d).withColumn("on", F.col("x") > 300), ["entity"], "rn", ["x"], "on").select("event_id", F.round("x", 6).alias("x"))


@_query("WITH RECURSIVE " + P.OBS + ", e AS (SELECT entity, rn, x AS s FROM obs WHERE rn = 1 UNION ALL SELECT o.entity, o.rn, 0.5::DOUBLE * o.x + 0.5::DOUBLE * e.s FROM e JOIN obs o ON o.entity = e.entity AND o.rn = e.rn + 1) SELECT entity, rn, s AS smoothed FROM e")
def ema_smooth(spark, d):
    s = scans.smooth_exponential(P.obs(spark, d), ["entity"], "rn", "x")
    return s.select("entity", "rn", "smoothed")


@_query("WITH RECURSIVE " + P.OBS + ", t AS (SELECT entity, sec FROM obs WHERE role = 'error'), k AS (SELECT entity, min(sec) AS sec FROM t GROUP BY entity UNION ALL SELECT k.entity, (SELECT min(t.sec) FROM t WHERE t.entity = k.entity AND t.sec >= k.sec + 90000) FROM k WHERE EXISTS (SELECT 1 FROM t WHERE t.entity = k.entity AND t.sec >= k.sec + 90000)) SELECT entity, sec FROM k")
def cooldown_events(spark, d):
    return scans.cooldown(P.obs(spark, d).filter("role = 'error'"), ["entity"], "sec", 90_000)


@_query(_obs_sql("""SELECT team, min(a) AS start, max(b) AS "end", min(sec) AS "trigger" FROM (SELECT *, sum(new) OVER (PARTITION BY team ORDER BY a, b, sec ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY team ORDER BY a, b, sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM (
 SELECT team, sec, greatest(sec - 300, 0) AS a, sec + 300 AS b FROM obs WHERE role = 'error'))) GROUP BY team, g"""))
def clip_windows(spark, d):
    return tall.clip_windows(P.obs(spark, d).filter("role = 'error'"), ["team"], "sec", 300, 300)


@_query(_obs_sql("SELECT e.event_id, count(*) AS readings, round(max(CASE WHEN v.event_id % 2 = 0 THEN v.x * 1.60934::DOUBLE ELSE v.x END), 6) AS kmh FROM obs e JOIN obs v ON v.team = e.team AND v.role = 'view' AND v.sec BETWEEN e.sec - 900 AND e.sec + 900 WHERE e.role = 'error' GROUP BY e.event_id"))
def radar_range_max(spark, d):
    o = P.obs(spark, d)
    trig = o.filter("role = 'error'").select("team", "event_id", "sec")
    unit = F.when(F.col("event_id") % 2 == 0, " mph ").otherwise("kph")
    read = o.filter("role = 'view'").select("team", F.col("sec").alias("at"), T.kmh(F.col("x"), unit).alias("kmh"))
    return joins.band(trig, read, ["team"], "sec", "at", 900, 900).groupBy("event_id").agg(F.count("*").alias("readings"), F.round(F.max("kmh"), 6).alias("kmh"))


@_query("WITH " + P.SEG + """ SELECT entity, min(start) AS start, max("end") AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY entity ORDER BY start, "end", id ROWS UNBOUNDED PRECEDING) AS g FROM (
 SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY entity ORDER BY start, "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM seg)) GROUP BY entity, g""")
def merge_intervals(spark, d):
    return tall.merge_intervals(P.seg(spark, d), ["entity"], "start", "end")


@_query("WITH " + P.SEG + """ SELECT a.id AS a, b.id AS b, greatest(a.start, b.start) AS lo, least(a."end", b."end") AS hi FROM seg a JOIN seg b ON a.entity = b.entity AND a.id < b.id AND a.start <= b."end" AND b.start <= a."end" WHERE (least(a."end", b."end") - greatest(a.start, b.start)) > 0.1::DOUBLE * (a."end" - a.start)""")
def relabel_candidates(spark, d):
    s = P.seg(spark, d)
    a = s.select("entity", F.col("id").alias("a"), F.col("start").alias("s1"), F.col("end").alias("e1"))
    b = s.select("entity", F.col("id").alias("b"), F.col("start").alias("s2"), F.col("end").alias("e2"))
    o = joins.overlap(a, b, ["entity"], ("s1", "e1"), ("s2", "e2"), 64)
    return o.filter((F.col("a") < F.col("b")) & (F.col("hi") - F.col("lo") > 0.1 * (F.col("e1") - F.col("s1")))).select("a", "b", "lo", "hi")


@_query("SELECT month, n, CAST(coalesce(sum(n) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1)")
def chapter_offsets(spark, d):
    m = P.table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    return tall.running_offset(m.withColumn("_all", F.lit(1)), ["_all"], "month", "n").drop("_all")


@_query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT vec_id, label, team, round(score, 6) AS score FROM (SELECT e.vec_id, e.label, r.label AS team, avg(list_cosine_similarity(e.v, r.v)) AS score FROM e JOIN e r ON r.vec_id <> e.vec_id GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, team) = 1""")
def team_similarity_all(spark, d):
    # the references are all vectors
    m = vectors.mean_similarity(P.table(spark, d, "embeddings"), "vec_id", "embedding", "label").withColumnRenamed("id", "vec_id")
    w = Window.partitionBy("vec_id").orderBy(F.desc("score"), "team")
    return m.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("vec_id", "label", "team", F.round("score", 6).alias("score"))


@_query("""WITH h AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda v: abs(v)) AS p FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(1 - sqrt(greatest(0.0, 1 - list_sum(list_transform(range(1, len(a.p) + 1), lambda i: sqrt(a.p[i] * b.p[i]))) / sqrt(list_sum(a.p) * list_sum(b.p)))), 6) AS similarity FROM h a JOIN h b ON b.vec_id = a.vec_id + 1""")
def bhattacharyya_match(spark, d):
    h = P.table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("p"))
    b = h.select(F.col("vec_id").alias("b"), F.col("p").alias("q"), (F.col("vec_id") - 1).alias("a"))
    j = h.withColumnRenamed("vec_id", "a").join(b, "a")
    return j.select("a", "b", F.round(G.bhattacharyya_similarity(F.col("p"), F.col("q")), 6).alias("similarity"))


@_query("""WITH h AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda v: abs(v)) AS p FROM embeddings),
r AS (SELECT team, list(x ORDER BY i) AS q FROM (SELECT label AS team, i, avg(x) AS x FROM (SELECT label, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS i FROM h) GROUP BY ALL) GROUP BY team),
m AS (SELECT vec_id, team, 1 - sqrt(greatest(0.0, 1 - list_sum(list_transform(range(1, len(p) + 1), lambda i: sqrt(p[i] * q[i]))) / sqrt(list_sum(p) * list_sum(q)))) AS s FROM h, r)
SELECT vec_id, team, round(s, 6) AS similarity FROM m QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, team) = 1""")
def match_team_histograms(spark, d):
    h = P.table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("p"))
    m = vectors.match_histograms(h, "vec_id", "p", vectors.team_histograms(h, "label", "p"))
    return m.select(F.col("id").alias("vec_id"), "team", F.round("similarity", 6).alias("similarity"))


_INTER = "greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_AREA = lambda q: f"({q}.x2 - {q}.x1) * ({q}.y2 - {q}.y1)"


@_query(f"WITH {P.BOX} SELECT a.image, a.det AS left_id, b.det AS right_id, round({_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE), 6) AS value FROM box a JOIN box b ON a.image = b.image WHERE a.det < b.det AND {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) >= 0.05")
def iou_pairs(spark, d):
    b = P.box(spark, d)
    return boxes.pairs(b, b, ["image"], "det", "det", least=0.05).filter("left_id < right_id").withColumn("value", F.round("value", 6))


@_query(f"WITH {P.BOX} SELECT image, det FROM box a WHERE NOT EXISTS (SELECT 1 FROM box b WHERE a.image = b.image AND a.cls = b.cls AND a.det <> b.det AND {_AREA('b')} > {_AREA('a')} AND {_INTER} / (least({_AREA('a')}, {_AREA('b')}) + 1e-6::DOUBLE) >= 0.5 AND least({_AREA('a')}, {_AREA('b')}) / (greatest({_AREA('a')}, {_AREA('b')}) + 1e-6::DOUBLE) <= 0.6)")
def enclosed_removal(spark, d):
    return boxes.without_enclosed(P.box(spark, d), ["image", "cls"], "det", 0.5, 0.6).select("image", "det")


@_query(f"""WITH RECURSIVE {P.BOX}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image ORDER BY conf DESC, x1, y1, x2, y2) AS r FROM box),
sup AS MATERIALIZED (SELECT a.image, b.r, list(a.r) AS by_ FROM o a JOIN o b ON a.image = b.image AND a.cls = b.cls AND a.r < b.r WHERE {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) > 0.3::DOUBLE GROUP BY ALL),
n AS MATERIALIZED (SELECT o.image, o.r, o.det, o.conf, coalesce(sup.by_, []) AS by_ FROM o LEFT JOIN sup ON sup.image = o.image AND sup.r = o.r),
st AS (SELECT image, r, det, conf, true AS keep, [r] AS kept FROM n WHERE r = 1 UNION ALL
 SELECT n.image, n.r, n.det, n.conf, len(list_intersect(st.kept, n.by_)) = 0, CASE WHEN len(list_intersect(st.kept, n.by_)) = 0 THEN list_append(st.kept, n.r) ELSE st.kept END FROM st JOIN n ON n.image = st.image AND n.r = st.r + 1)
SELECT image, det, conf FROM st WHERE keep""")
def nms(spark, d):
    return boxes.suppress(P.box(spark, d), "image", 0.0, 0.3).select("image", "det", "conf")


_MANY = "mb AS (SELECT * FROM (SELECT image, det, x1, y1, x2, y2, unnest([0, 1, 2]) AS cls, unnest([conf, 110000 - conf, 1000 * (x2 - x1)]) AS conf FROM box) WHERE conf > 45000)"


@_query(_SQL["nms"].replace(P.BOX, f"{P.BOX}, {_MANY}").replace("AS r FROM box)", "AS r FROM mb)").replace("SELECT image, det, conf FROM st WHERE keep", "SELECT o.image, o.det, o.cls, o.conf FROM st JOIN o ON o.image = st.image AND o.r = st.r WHERE st.keep"))
def nms_many_labels(spark, d):
    b = P.box(spark, d).drop("cls").withColumn("scores", F.array("conf", 110_000 - F.col("conf"), 1000 * (F.col("x2") - F.col("x1")))).drop("conf")
    return boxes.suppress(boxes.class_candidates(b, "scores", 45_000), "image", 0.0, 0.3, None, None).select("image", "det", "cls", "conf")


# one image a class, with boxes all over it; in SQL they meet by stripes
@_query(f"""WITH {P.BOX}, cb AS (SELECT cls, image * 10 + det AS id, x1 + image % 4999 * 30 AS x1, y1 + det * 200 AS y1, x2 + image % 4999 * 30 AS x2, y2 + det * 200 AS y2 FROM box),
st AS (SELECT *, unnest(range(CAST(floor(x1 / 60) AS BIGINT), CAST(floor(x2 / 60) AS BIGINT) + 1)) AS k FROM cb)
SELECT DISTINCT a.cls, a.id AS left_id, b.id AS right_id, round({_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE), 6) AS value FROM st a JOIN st b ON a.cls = b.cls AND a.k = b.k AND a.id < b.id WHERE {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) >= 0.3::DOUBLE""")
def crowd_pairs(spark, d):
    b = P.box(spark, d)
    x, y = F.col("image") % 4999 * 30, F.col("det") * 200
    crowd = b.select("cls", (F.col("image") * 10 + F.col("det")).alias("id"), (F.col("x1") + x).alias("x1"), (F.col("y1") + y).alias("y1"), (F.col("x2") + x).alias("x2"), (F.col("y2") + y).alias("y2"))
    return boxes.overlapping(crowd, ["cls"], "id", least=0.3, cell=60.0, digits=6)


def _matches(spark, d):
    b = P.box(spark, d)
    return boxes.pairs(b.filter("det % 2 = 1"), b.filter("det % 2 = 0"), ["image"], "det", "det", least=0.02)


_PAIRS = f"{P.BOX}, pr AS (SELECT a.image, a.det AS left_id, b.det AS right_id, {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) AS value FROM box a JOIN box b ON a.image = b.image WHERE a.det % 2 = 1 AND b.det % 2 = 0 AND {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) >= 0.02)"


@_query(f"WITH {_PAIRS}, o AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY image, left_id ORDER BY value DESC, right_id) = 1) SELECT image, left_id, right_id, round(value, 6) AS value FROM o QUALIFY row_number() OVER (PARTITION BY image, right_id ORDER BY left_id) = 1")
def best_match_dedup(spark, d):
    return joins.best_pairs(_matches(spark, d), ["image"], "left_id", "right_id", "value", "left").withColumn("value", F.round("value", 6))


@_query(f"""WITH RECURSIVE {_PAIRS}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image ORDER BY value DESC, left_id, right_id) AS r FROM pr),
st AS (SELECT image, r, left_id, right_id, value, true AS keep, [left_id, right_id] AS used FROM o WHERE r = 1 UNION ALL
 SELECT o.image, o.r, o.left_id, o.right_id, o.value, NOT list_contains(st.used, o.left_id) AND NOT list_contains(st.used, o.right_id), CASE WHEN NOT list_contains(st.used, o.left_id) AND NOT list_contains(st.used, o.right_id) THEN list_concat(st.used, [o.left_id, o.right_id]) ELSE st.used END FROM st JOIN o ON o.image = st.image AND o.r = st.r + 1)
SELECT image, left_id, right_id, value FROM st WHERE keep""")
def greedy_assign(spark, d):
    return joins.greedy_pairs(_matches(spark, d), ["image"], "left_id", "right_id", "value")


def _scored(spark, d):
    x = P.table(spark, d, "labels").join(P.table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return x.select(F.col("doc_id").alias("id"), F.col("lang").alias("cls"), F.col("n_chars").alias("score"), F.col("quality").alias("hit"))


_LAB = "lab AS (SELECT l.doc_id AS id, d.lang AS cls, d.n_chars AS score, l.quality AS hit FROM labels l JOIN documents d USING (doc_id))"
_CURVE = """cv AS (SELECT c.*, tp / (p.n + 1e-16::DOUBLE) AS recall, tp / CAST(rank AS DOUBLE) AS precision FROM (SELECT cls, row_number() OVER w AS rank, CAST(sum(hit) OVER (PARTITION BY cls ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp FROM lab WINDOW w AS (PARTITION BY cls ORDER BY score DESC, id)) c
 JOIN (SELECT cls, sum(hit) AS n FROM lab GROUP BY cls) p USING (cls))"""


def _curve(spark, d):
    s = _scored(spark, d)
    return stats.precision_recall(s, "cls", "score", "hit", s.groupBy("cls").agg(F.sum("hit").alias("positives")))


@_query(f"WITH {_LAB}, {_CURVE} SELECT cls, rank, tp, rank - tp AS fp, round(recall, 6) AS recall, round(precision, 6) AS precision FROM cv")
def precision_recall_curve(spark, d):
    return _curve(spark, d).withColumn("recall", F.round("recall", 6)).withColumn("precision", F.round("precision", 6))


@_query(f"""WITH {_LAB}, {_CURVE}, pt AS (SELECT cls, rank AS pos, recall, precision FROM cv UNION ALL SELECT DISTINCT cls, 0, 0.0, 1.0 FROM cv UNION ALL SELECT cls, max(rank) + 1, 1.0, 0.0 FROM cv GROUP BY cls),
en AS (SELECT *, max(precision) OVER (PARTITION BY cls ORDER BY pos DESC ROWS UNBOUNDED PRECEDING) AS env FROM pt),
nx AS (SELECT *, lead(recall) OVER (PARTITION BY cls ORDER BY pos) AS r2, lead(env) OVER (PARTITION BY cls ORDER BY pos) AS e2 FROM en),
g AS (SELECT i / 100.0::DOUBLE AS r FROM range(0, 101) t(i))
SELECT cls, round(sum((env + (e2 - env) * (r - recall) / (r2 - recall)) * CASE WHEN r = 0 OR r = 1 THEN 0.005 ELSE 0.01 END), 5) AS ap FROM nx JOIN g ON r2 > recall AND r >= recall AND (r < r2 OR (r = 1 AND r2 >= 1)) GROUP BY cls""")
def ap_per_class(spark, d):
    return stats.average_precision(_curve(spark, d), "cls").select("cls", F.round("ap", 5).alias("ap"))


@_query(f"WITH {_LAB} SELECT CAST(CASE WHEN hit = 1 THEN 'good' ELSE 'background' END AS VARCHAR) AS truth, CASE WHEN score > 1000 THEN 'good' ELSE 'background' END AS guess, count(*) AS n FROM lab GROUP BY ALL")
def confusion_matrix(spark, d):
    s = _scored(spark, d).select(F.when(F.col("hit") == 1, "good").alias("t"), F.when(F.col("score") > 1000, "good").alias("g"))
    return stats.confusion(s, "t", "g")


@_query(f"""WITH {_LAB}, c AS (SELECT hit AS t, CASE WHEN score > 1000 THEN 1 ELSE 0 END AS g FROM lab), k AS (SELECT DISTINCT t AS c FROM c), i AS (SELECT c, (SELECT count(*) FROM c WHERE t = k.c) AS t, (SELECT count(*) FROM c WHERE g = k.c) AS g, (SELECT count(*) FROM c WHERE t = k.c AND g = k.c) AS i FROM k)
SELECT round(avg(i / CAST(t + g - i + 1 AS DOUBLE)), 6) AS mean_iou, round(sum(i / CAST(t + g - i + 1 AS DOUBLE) * t) / sum(t), 6) AS weighted_iou FROM i""")
def semantic_iou(spark, d):
    s = _scored(spark, d).select(F.col("hit").alias("t"), F.when(F.col("score") > 1000, 1).otherwise(0).alias("g"))
    m = stats.mean_iou(stats.confusion(s, "t", "g"))
    return m.select(F.round("mean_iou", 6).alias("mean_iou"), F.round("weighted_iou", 6).alias("weighted_iou"))


@_query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
k AS (SELECT e.vec_id, e.label, r.label AS guess, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_cosine_similarity(e.v, r.v) DESC, r.vec_id) AS p FROM e JOIN e r ON e.vec_id <> r.vec_id)
SELECT round(avg(a), 6) AS top1, round(avg(b), 6) AS topk FROM (SELECT vec_id, max(CASE WHEN p = 1 AND guess = label THEN 1.0 ELSE 0.0 END) AS a, max(CASE WHEN p <= 5 AND guess = label THEN 1.0 ELSE 0.0 END) AS b FROM k GROUP BY vec_id)""")
def topk_accuracy_all(spark, d):
    # the candidates are all vectors
    k = vectors.nearest_labels(P.table(spark, d, "embeddings"), "vec_id", "embedding", "label")
    m = stats.top_k_accuracy(k, "label", "ranked")
    return m.select(F.round("top1", 6).alias("top1"), F.round("topk", 6).alias("topk"))


@_query()
def edit_distance_whole(spark, d):
    # whole texts by characters; DuckDB counts bytes, so there is no SQL
    b = P.table(spark, d, "benchmark").select("item_id", F.col("text").alias("t"))
    j = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("t").alias("u")), "item_id")
    return j.select("item_id", F.levenshtein("t", "u").cast("long").alias("distance"), F.round(L.edit_similarity(F.col("t"), F.col("u")), 6).alias("similarity"))


@_query("SELECT conv_id, turn, nullif(CASE WHEN length(regexp_replace(text, '\\s+', '', 'g')) <= 40 THEN regexp_replace(lower(regexp_replace(text, '\\s+', '', 'g')), '[^a-z0-9]', '', 'g') END, '') AS label FROM conversations")
def label_normalise(spark, d):
    return P.table(spark, d, "conversations").select("conv_id", "turn", L.normal_label(F.col("text"), 40).alias("label"))


@_query(f"WITH {P.BOX} SELECT cls, n, round((1.0::DOUBLE / n) / sum(1.0::DOUBLE / n) OVER (), 8) AS weight FROM (SELECT cls, count(*) AS n FROM box GROUP BY cls)")
def class_weights(spark, d):
    return stats.class_weights(P.box(spark, d), "cls").withColumn("weight", F.round("weight", 8))


@_query(f"WITH {P.BOX} SELECT coalesce(cls, 'all') AS cls, count(*) AS instances, count(DISTINCT image) AS images FROM box GROUP BY GROUPING SETS ((cls), ())")
def dataset_summary(spark, d):
    return P.box(spark, d).rollup("cls").agg(F.count("*").alias("instances"), F.count_distinct("image").alias("images")).withColumn("cls", F.coalesce("cls", F.lit("all")))


@_query("SELECT event_id, event_type FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, event_type FROM events WHERE value > 400")
def union_all(spark, d):
    e = P.table(spark, d, "events").select("event_id", "event_type", "value")
    return e.filter("event_type = 'view'").select("event_id", "event_type").unionByName(e.filter("value > 400").drop("value"), allowMissingColumns=True)


@_query("SELECT user_id FROM events WHERE event_type = 'view' UNION SELECT user_id FROM events WHERE value > 400")
def union_distinct(spark, d):
    e = P.table(spark, d, "events")
    return e.filter("event_type = 'view'").select("user_id").union(e.filter("value > 400").select("user_id")).distinct()


@_query(_obs_sql("SELECT DISTINCT frame FROM obs EXCEPT SELECT frame FROM obs WHERE role = 'purchase'"))
def except_frames(spark, d):
    o = P.obs(spark, d)
    return o.select("frame").distinct().join(o.filter("role = 'purchase'").select("frame").distinct(), "frame", "left_anti")


@_query(_obs_sql("SELECT coalesce(a.frame, b.frame) AS frame, a.n AS keepers, b.n AS balls FROM (SELECT frame, count(*) AS n FROM obs WHERE role = 'view' AND team = 0 GROUP BY frame) a FULL JOIN (SELECT frame, count(*) AS n FROM obs WHERE role = 'purchase' AND team = 1 GROUP BY frame) b ON a.frame = b.frame"))
def full_outer_align(spark, d):
    o = P.obs(spark, d)
    a = o.filter("role = 'view' AND team = 0").groupBy("frame").agg(F.count("*").alias("keepers"))
    return a.join(o.filter("role = 'purchase' AND team = 1").groupBy("frame").agg(F.count("*").alias("balls")), "frame", "full_outer")


@_query("SELECT c.c_custkey, coalesce(o.o_orderkey, -1) AS latest, coalesce(o.o_totalprice, c.c_acctbal) AS amount FROM customer c LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON o.o_custkey = c.c_custkey")
def left_latest_fallback(spark, d):
    last = P.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("o"))
    j = P.table(spark, d, "customer").join(last, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("o.o_orderkey", F.lit(-1)).alias("latest"), F.coalesce("o.o_totalprice", "c_acctbal").alias("amount"))


@_query(_obs_sql("SELECT v.event_id, p.event_id AS purchase FROM obs v ASOF LEFT JOIN (SELECT entity, sec, event_id FROM obs WHERE role = 'purchase' QUALIFY row_number() OVER (PARTITION BY entity, sec ORDER BY event_id DESC) = 1) p ON p.entity = v.entity AND p.sec <= v.sec WHERE v.role = 'view'"))
def as_of_purchase(spark, d):
    o = P.obs(spark, d)
    buys = o.filter("role = 'purchase'").groupBy("entity", "sec").agg(F.max("event_id").alias("purchase")).withColumnRenamed("sec", "at")
    return joins.as_of(o.filter("role = 'view'").select("entity", "event_id", "sec"), buys, ["entity"], "sec", "at", ["purchase"]).select("event_id", "purchase")


@_query(_obs_sql("SELECT frame, team, digit, entity FROM (SELECT frame, team, CAST(y AS BIGINT) % 10 AS digit, entity, row_number() OVER (PARTITION BY frame, team, CAST(y AS BIGINT) % 10 ORDER BY x DESC, entity) AS r FROM track) WHERE r > 1", P.TRACK))
def duplicate_ids_in_frame(spark, d):
    t = P.track(P.obs(spark, d)).withColumn("digit", F.col("y").cast("long") % 10)
    w = Window.partitionBy("frame", "team", "digit").orderBy(F.desc("x"), "entity")
    return t.withColumn("_r", F.row_number().over(w)).filter("_r > 1").select("frame", "team", "digit", "entity")


@_query(_obs_sql("SELECT event_id, round((2 * x + 10) / (0.01::DOUBLE * y + 1), 6) AS px, round((3 * y - 5) / (0.01::DOUBLE * y + 1), 6) AS py FROM obs"))
def homography_project(spark, d):
    px, py = G.homography([2, 0, 10, 0, 3, -5, 0, 0.01, 1], F.col("x"), F.col("y"))
    return P.obs(spark, d).select("event_id", F.round(px, 6).alias("px"), F.round(py, 6).alias("py"))


@_query(_obs_sql("SELECT event_id, CASE WHEN frame % 200000 <= 82956 THEN frame % 200000 + 9500 ELSE frame % 200000 - 82957 + 119340 END AS video, printf('%03d:%02d', CAST(floor((frame % 200000) / 29.97::DOUBLE / 60) AS BIGINT), CAST(floor((frame % 200000) / 29.97::DOUBLE) AS BIGINT) % 60) AS clock FROM obs"))
def frame_clocks(spark, d):
    f = F.col("frame") % 200_000
    return P.obs(spark, d).select("event_id", T.video_frame(f, 317, 3085, 3982).alias("video"), T.frame_minutes(f).alias("clock"))


@_query(_obs_sql("SELECT w, count(*) AS n, round(min(x), 4) AS low FROM (SELECT x, unnest(range(greatest(CAST(floor((rn - 30) / 15.0) AS BIGINT) + 1, 0), CAST(floor(rn / 15.0) AS BIGINT) + 1)) AS w FROM obs) GROUP BY w"))
def sliding_windows(spark, d):
    return tall.sliding(P.obs(spark, d), "rn", 30, 15, "w").groupBy("w").agg(F.count("*").alias("n"), F.round(F.min("x"), 4).alias("low"))


@_query(f"WITH {P.BOX} SELECT image, det, round((x1 + x2) / 2 / 200, 6) AS cx, round((y1 + y2) / 2 / 200, 6) AS cy, round((x2 - x1) / 200, 6) AS w, round((y2 - y1) / 200, 6) AS h FROM box")
def box_forms(spark, d):
    form = B.to_normalised(boxes.box(), 200.0, 200.0)
    return P.box(spark, d).select("image", "det", *[F.round(c, 6).alias(n) for c, n in zip(form, ("cx", "cy", "w", "h"))])


def _load() -> None:
    """The modules that register further queries here."""
    from . import evaluation, filters, forms, more_joins, rosters  # noqa: F401


def queries():
    from . import grouped

    _load()
    return _QUERIES | grouped.queries()


def oracle_sql():
    from . import grouped

    _load()
    return _SQL | grouped.oracle_sql()
