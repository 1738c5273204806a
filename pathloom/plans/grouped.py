"""Order-dependent kernels, one group at a time, and the roster rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import keeper, roster, tracks
from . import proxies as P


def _o(spark, d):
    return P.obs(spark, d).select("entity", "team", "role", "rn", "x", "y")


def window_split(spark, d):
    return tracks.split_by_label(_o(spark, d), ["entity"], "rn", "role", 5, 0.6).groupBy("entity", "piece").agg(F.min("rn").alias("start"), F.max("rn").alias("end"), F.count("*").alias("n"))


def savgol_smooth(spark, d):
    return tracks.smooth(_o(spark, d), ["entity"], "rn", ["x", "y"], 11, 3)


def spike_repair(spark, d):
    return tracks.repair_spikes(_o(spark, d), ["entity"], "rn", window=41, step=20, prominence=20.0)


def stitch_tracks(spark, d):
    p = P.track(P.obs(spark, d)).withColumn("b", F.floor(F.col("frame") / 100))
    a, z = F.min(F.struct("frame", "x", "y")), F.max(F.struct("frame", "x", "y"))
    g = p.groupBy("team", "entity", "b").agg(a.alias("a"), z.alias("z"))
    g = g.select("team", (F.col("entity") * 1_000_000 + F.col("b")).alias("piece"), F.col("a.frame").alias("start"), F.col("z.frame").alias("end"), F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("z.x").alias("x1"), F.col("z.y").alias("y1"))
    return tracks.stitch(g, ["team"])


def ball_outliers(spark, d):
    return tracks.ball_outliers(_o(spark, d), ["entity"], "rn")


def static_clusters(spark, d):
    return tracks.static_clusters(_o(spark, d), ["entity"], "rn", eps=40.0, extent=60.0)


def kalman_smooth(spark, d):
    return tracks.kalman(_o(spark, d), ["entity"], "rn")


def line_pieces(spark, d):
    return tracks.line_pieces(_o(spark, d), ["entity"], "rn", residual=60.0, least=5)


def fuse_ball(spark, d):
    o = P.obs(spark, d).filter("role = 'purchase'").withColumn("conf", F.col("x") / 500)
    return tracks.fuse_ball(o.select("team", "frame", "x", "y", "conf"), ["team"], "frame")


def keeper_tags(spark, d):
    """Made-up skeletons: 17 points about each observation; the ball is the entity's next one."""
    o = _o(spark, d)
    w = Window.partitionBy("entity").orderBy("rn")
    point = lambda i: F.array(F.col("x") + (i % 5) * 3.0, F.col("y") + i * 4.0)
    box = F.array(F.lead("x").over(w), F.lead("y").over(w), F.lead("x").over(w) + 20, F.lead("y").over(w) + 20)
    o = o.withColumn("skel", F.array(*[point(i) for i in range(17)])).withColumn("ball", F.when(F.lead("x").over(w).isNotNull(), box))
    return keeper.classify(o.select(F.col("entity").alias("clip"), F.col("rn").alias("frame"), "skel", "ball", F.lit(30.0).alias("ball_speed")))


def _roster_tracks(spark, d):
    s = P.seg(spark, d)
    return s.select(F.col("entity").cast("string").alias("team"), F.col("id").alias("track"), (F.col("id") % 3 + 1).cast("int").alias("number"), (F.col("conf") / 1e6).alias("conf"), "start", "end")


def resolve_numbers(spark, d):
    t = _roster_tracks(spark, d)
    numbers = F.array(*map(F.lit, (1, 2, 3, 10, 20, 21, 31)))
    return roster.resolve_numbers(t, t.select("team").distinct().withColumn("numbers", numbers), 64)


def relabel_excess(spark, d):
    t = _roster_tracks(spark, d)
    w = t.groupBy("team").agg(F.count("*").alias("n"), F.min("start").alias("w_start"), F.max("end").alias("w_end"))
    return roster.relabel_excess(t, w, 10, 0.2, bucket=64)


def queries():
    return {f.__name__: f for f in (window_split, savgol_smooth, spike_repair, stitch_tracks, ball_outliers, static_clusters, kalman_smooth, line_pieces, fuse_ball, keeper_tags, resolve_numbers, relabel_excess)}



_SPLIT = f"""WITH RECURSIVE {P.OBS}, m AS (SELECT a.entity, a.rn, b.role AS v, count(*) AS c FROM obs a JOIN obs b ON b.entity = a.entity AND b.rn BETWEEN a.rn AND a.rn + 4 GROUP BY ALL),
best AS MATERIALIZED (SELECT o.entity, o.rn, o.role, m.v, m.c, o.rn + 4 <= max(o.rn) OVER (PARTITION BY o.entity) AS fits FROM obs o JOIN (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY entity, rn ORDER BY c DESC, v) = 1) m USING (entity, rn)),
st AS (SELECT entity, rn, role AS cur, 0 AS piece FROM best WHERE rn = 1 UNION ALL
 SELECT b.entity, b.rn, CASE WHEN b.role <> st.cur AND b.fits AND b.v <> st.cur AND b.c >= 3 THEN b.v ELSE st.cur END, CASE WHEN b.role <> st.cur AND b.fits AND b.v <> st.cur AND b.c >= 3 THEN st.piece + 1 ELSE st.piece END FROM st JOIN best b ON b.entity = st.entity AND b.rn = st.rn + 1)
SELECT entity, CASE WHEN piece < 26 THEN chr(97 + piece) ELSE chr(96 + piece // 26) || chr(97 + piece % 26) END AS piece, min(rn) AS start, max(rn) AS "end", count(*) AS n FROM st GROUP BY entity, st.piece"""

_FUSE = f"""WITH RECURSIVE {P.OBS}, c AS MATERIALIZED (SELECT team, frame, x, y, x / 500 AS conf, dense_rank() OVER (PARTITION BY team ORDER BY frame) AS i FROM obs WHERE role = 'purchase' AND x / 500 >= 0.25::DOUBLE),
st AS (SELECT team, i, arg_min(struct_pack(x := x, y := y, conf := conf, frame := frame), struct_pack(a := -conf, x := x, y := y)) AS p FROM c WHERE i = 1 GROUP BY team, i UNION ALL
 SELECT c.team, c.i, arg_min(struct_pack(x := c.x, y := c.y, conf := c.conf, frame := c.frame), struct_pack(d := sqrt((c.x - st.p.x) * (c.x - st.p.x) + (c.y - st.p.y) * (c.y - st.p.y)), a := -c.conf, x := c.x, y := c.y)) AS p FROM st JOIN c ON c.team = st.team AND c.i = st.i + 1 GROUP BY c.team, c.i)
SELECT team, p.frame AS frame, p.x AS x, p.y AS y, p.conf AS conf FROM st"""

_TRACKS = f"""{P.SEG}, t AS MATERIALIZED (SELECT CAST(entity AS VARCHAR) AS team, id AS track, CAST(id % 3 + 1 AS INTEGER) AS number, conf / 1e6::DOUBLE AS conf, start, "end" FROM seg)"""

_RESOLVE = f"""WITH {_TRACKS}, p AS MATERIALIZED (SELECT a.team, a.track, a.number, a.conf, b.track AS o_track, b.number AS o_number, b.conf AS o_conf FROM t a JOIN t b ON a.team = b.team AND a.track <> b.track AND a.start <= b."end" AND b.start <= a."end"),
l AS MATERIALIZED (SELECT DISTINCT team, track, number FROM p WHERE number = o_number AND (o_conf > conf OR (o_conf = conf AND o_track < track))),
r AS (SELECT unnest([1, 2, 3, 10, 20, 21, 31]) AS option, unnest(range(0, 7)) AS pos),
f AS (SELECT l.team, l.track, arg_min(r.option, r.pos) AS option FROM l JOIN r ON contains(CAST(r.option AS VARCHAR), CAST(l.number AS VARCHAR)) AND r.option <> l.number WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.team = l.team AND p.track = l.track AND p.o_number = r.option) GROUP BY ALL)
SELECT t.team, t.track, CASE WHEN l.track IS NULL THEN t.number ELSE f.option END AS number, t.conf, t.start, t."end", CASE WHEN l.track IS NULL THEN 'kept' WHEN f.option IS NOT NULL THEN 'changed' ELSE 'unsure' END AS state FROM t LEFT JOIN l USING (team, track) LEFT JOIN f USING (team, track)"""

_RELABEL = f"""WITH {_TRACKS}, w AS (SELECT team, count(*) AS n, min(start) AS a, max("end") AS b FROM t GROUP BY team),
g AS (SELECT track FROM (SELECT t.track, w.n, row_number() OVER (PARTITION BY t.team ORDER BY t.conf, t.track) AS r FROM t JOIN w USING (team) WHERE t.conf <= 0.2::DOUBLE AND least(t."end", w.b) - greatest(t.start, w.a) + 1 > 0.1::DOUBLE * (t."end" - t.start + 1)) WHERE r <= n - 10)
SELECT CASE WHEN g.track IS NULL THEN t.team ELSE 'unsure' END AS team, t.track, t.number, t.conf, t.start, t."end", g.track IS NOT NULL AS relabelled FROM t LEFT JOIN g USING (track)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB text of those whose order a recursive query can follow."""
    return {"window_split": _SPLIT, "fuse_ball": _FUSE, "resolve_numbers": _RESOLVE, "relabel_excess": _RELABEL}
