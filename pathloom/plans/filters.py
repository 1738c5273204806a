"""Queries of the filters and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import labels as L
from ..operators import boxes, filters
from . import proxies as P
from .catalog import _obs_sql, _query


@_query(_obs_sql("SELECT event_id, CASE WHEN frame BETWEEN 473400 AND 473500 THEN frame - 473399 ELSE frame - 473800 + 102 END AS game_frame FROM obs WHERE frame BETWEEN 473400 AND 473500 OR frame BETWEEN 473800 AND 474000"))
def game_intervals(spark, d):
    return filters.game_time(P.obs(spark, d), "frame", [(473_400, 473_500), (473_800, 474_000)]).select("event_id", "game_frame")


@_query(_obs_sql("SELECT entity, frame, x, y FROM track WHERE frame BETWEEN 473500 AND 473700", P.TRACK))
def track_time_slice(spark, d):
    return filters.time_slice(P.track(P.obs(spark, d)), "frame", 473_500, 473_700).select("entity", "frame", "x", "y")


@_query(_obs_sql("SELECT event_id, entity, rn - 10 AS number FROM obs WHERE rn BETWEEN 11 AND 20"))
def slice_and_renumber(spark, d):
    return filters.frame_slice(P.obs(spark, d), ["entity"], "rn", 10, 20).select("event_id", "entity", F.col("number").cast("long").alias("number"))


@_query(f"WITH {P.BOX} SELECT image, det, conf FROM box WHERE conf >= 30000 AND cls IN ('A', 'R')")
def confidence_class_filter(spark, d):
    return filters.confident(P.box(spark, d), 30_000.0, ["A", "R"]).select("image", "det", "conf")


@_query("""SELECT conv_id, turn, trim(lower(role)) IN ('0', 'person', 'player') AS person, trim(lower(CAST(turn AS VARCHAR))) = '0' AS person_number, trim(lower(CAST(turn + 30 AS VARCHAR))) = '32' AS ball FROM (SELECT *, CASE WHEN turn % 3 = 0 THEN ' Person' ELSE role END AS r FROM conversations) t(conv_id, turn, was, text, role)""")
def class_predicates(spark, d):
    c = P.table(spark, d, "conversations")
    name = F.when(F.col("turn") % 3 == 0, " Person").otherwise(F.col("role"))
    return c.select("conv_id", "turn", filters.is_person_class(name).alias("person"), filters.is_person_class(F.col("turn")).alias("person_number"), filters.is_ball_class(F.col("turn") + 30).alias("ball"))


@_query(_obs_sql("SELECT entity, bool_and(role <> 'purchase') AS ball_like, count(*) AS n FROM obs GROUP BY entity"))
def ball_track_test(spark, d):
    maps = P.obs(spark, d).groupBy("entity").agg(F.collect_list(F.when(F.col("role") == "purchase", F.create_map(F.lit("home"), F.col("x"))).otherwise(F.create_map().cast("map<string,double>"))).alias("team_conf"), F.count("*").alias("n"))
    return maps.select("entity", filters.is_ball_track(F.col("team_conf")).alias("ball_like"), "n")


@_query(_obs_sql("SELECT event_id, x, y FROM (SELECT *, count(*) OVER w AS a, count(*) FILTER (x BETWEEN 0 AND 300 AND y BETWEEN 0 AND 80) OVER w AS b FROM obs WINDOW w AS (PARTITION BY entity)) WHERE a >= 10 AND b >= 10 AND x BETWEEN 0 AND 300 AND y BETWEEN 0 AND 80"))
def long_tracks_in_bounds(spark, d):
    return filters.long_tracks(P.obs(spark, d), ["entity"], 10, 300.0, 80.0).select("event_id", "x", "y")


@_query(_obs_sql("SELECT event_id FROM (SELECT *, avg(CASE WHEN least(x, y, 490.0 - x, 99.0 - y) < 30.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER (PARTITION BY entity) AS n FROM obs) WHERE n < 0.8::DOUBLE OR entity % 7 = 0"))
def away_from_edges(spark, d):
    o = P.obs(spark, d).withColumn("side", F.when(F.col("entity") % 7 == 0, "ball").otherwise("home"))
    return filters.away_from_edges(o, ["entity"], "side", 30.0, 0.8, 490.0, 99.0).select("event_id")


@_query(f"WITH {P.BOX} SELECT image, det FROM box WHERE (x2 - x1) * (y2 - y1) >= 1000")
def large_boxes(spark, d):
    return filters.large_boxes(P.box(spark, d), 1000.0).select("image", "det")


@_query(f"WITH {P.BOX} SELECT image, det, coalesce(y2 - y1 < 0.5::DOUBLE * lag(y2 - y1) OVER (PARTITION BY image ORDER BY det), false) AS dropped FROM box")
def height_drops(spark, d):
    return filters.height_drops(P.box(spark, d), ["image"], "det", F.col("y2") - F.col("y1")).select("image", "det", "dropped")


@_query("SELECT c_custkey FROM customer WHERE trim(CAST(c_custkey % 11 AS VARCHAR)) = '7' AND contains(c_mktsegment, 'U')")
def select_player(spark, d):
    t = P.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 11).cast("string").alias("jersey_num"), F.col("c_mktsegment").alias("team"))
    return filters.select_player(t, 7, "U").select("c_custkey")


@_query(f"""WITH {P.BOX}, t AS (SELECT * FROM (VALUES (0, 0, 0, 64, 64), (1, 48, 0, 112, 64), (2, 96, 0, 160, 64), (3, 0, 48, 64, 112), (4, 48, 48, 112, 112), (5, 96, 48, 160, 112), (6, 0, 96, 64, 160), (7, 48, 96, 112, 160), (8, 96, 96, 160, 160)) v(tile, a, b, c, e))
SELECT tile, count(*) AS n, min(det) AS first FROM box JOIN t ON (x1 + x2) / 2 >= a AND (x1 + x2) / 2 < c AND (y1 + y2) / 2 >= b AND (y1 + y2) / 2 < e GROUP BY tile""")
def tile_boxes(spark, d):
    tiles = B.tiles(160, 160, 64, 16)
    held = F.array(*[F.when(filters.in_tile(boxes.box(), t), F.lit(i)) for i, t in enumerate(tiles)])
    out = P.box(spark, d).select("det", F.explode(F.array_compact(held)).alias("tile"))
    return out.groupBy("tile").agg(F.count("*").alias("n"), F.min("det").alias("first"))


@_query(f"WITH {P.BOX} SELECT image, det, 0 AS cls FROM (SELECT *, count(*) OVER (PARTITION BY image) AS n FROM box WHERE cls IN ('N', 'R')) WHERE n > 2")
def labelled_images(spark, d):
    b = P.box(spark, d)
    kept = filters.labelled_images(b, "image", "cls", 2, ["N", "R"], True)
    return kept.select("image", "det", F.col("cls").cast("int").alias("cls"))


@_query(f"WITH {P.BOX} SELECT image, det, x2 - x1 >= 22 OR y2 - y1 >= 22 AS one, x2 - x1 >= 30 AND y2 - y1 >= 30 AS both_sides FROM box")
def ball_triggers(spark, d):
    return P.box(spark, d).select("image", "det", filters.triggered(boxes.box()).alias("one"), filters.triggered(boxes.box(), 30.0, True).alias("both_sides"))


@_query(f"""WITH {P.BOX} SELECT a.image, a.det FROM box a WHERE a.det > 1 AND NOT EXISTS (SELECT 1 FROM box b WHERE b.image = a.image AND b.det = 1 AND
  greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) / ((a.x2 - a.x1) * (a.y2 - a.y1) + 1e-7::DOUBLE) >= 0.3::DOUBLE)""")
def uncovered_boxes(spark, d):
    b = P.box(spark, d)
    cover = b.filter("det = 1").select("image", *[F.col(c).alias(f"c{c}") for c in boxes.BOX])
    return filters.uncovered(b.filter("det > 1"), cover, ["image"], "det", 0.3).select("image", "det")


@_query(f"WITH {P.BOX} SELECT image, det, CAST(number AS BIGINT) AS number FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY conf DESC, det) AS number FROM box) WHERE number <= 2")
def first_detections(spark, d):
    return filters.first_detections(P.box(spark, d), ["image"], 2).select("image", "det", F.col("number").cast("long").alias("number"))


@_query(_obs_sql("SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY frame ORDER BY x DESC, event_id) = 1 THEN y END AS skel FROM obs"))
def best_keeps_skeleton(spark, d):
    return filters.best_keeps(P.obs(spark, d).withColumnRenamed("y", "skel"), ["frame"], "x", "skel", "event_id").select("event_id", "skel")


@_query(_obs_sql("SELECT event_id FROM (SELECT event_id, f, max(f) OVER (PARTITION BY entity ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT *, frame - (event_id % 5) * 20 AS f FROM obs)) WHERE m IS NULL OR f > m"))
def monotone_frames(spark, d):
    o = P.obs(spark, d).withColumn("f", F.col("frame") - (F.col("event_id") % 5) * 20)
    return filters.later_than_before(o, ["entity"], "event_id", "f").select("event_id")


@_query("SELECT user_id, event_id, contains(t, 'goalkeeper') AS keeper, contains(t, 'referee') AS referee, t = 'ball' AS ball, NOT (contains(t, 'goalkeeper') OR contains(t, 'referee') OR t IN ('ball', 'unsure')) AS outfield, trim(replace(t, 'goalkeeper', '')) AS base, CASE WHEN t = 'ball' THEN 'Ball' WHEN contains(t, 'referee') THEN 'REF' WHEN contains(t, 'goalkeeper') THEN 'GK' WHEN n = 'unsure' THEN 'U' ELSE replace(regexp_replace(n, '[\\[\\] ]', '', 'g'), ',', '/') END AS shown FROM (SELECT *, (['home', 'homegoalkeeper', 'away', 'awaygoalkeeper', 'referee', 'ball', 'unsure'])[user_id % 7 + 1] AS t, (['7', 'unsure', '[7, 17]'])[event_id % 3 + 1] AS n FROM events)")
def role_predicates(spark, d):
    t = F.element_at(F.array(*map(F.lit, ("home", "homegoalkeeper", "away", "awaygoalkeeper", "referee", "ball", "unsure"))), (F.col("user_id") % 7 + 1).cast("int"))
    n = F.element_at(F.array(*map(F.lit, ("7", "unsure", "[7, 17]"))), (F.col("event_id") % 3 + 1).cast("int"))
    e = P.table(spark, d, "events").select("user_id", "event_id", t.alias("t"), n.alias("n"))
    t = F.col("t")
    return e.select("user_id", "event_id", L.is_goalkeeper(t).alias("keeper"), L.is_referee(t).alias("referee"), L.is_ball(t).alias("ball"), L.is_outfield(t).alias("outfield"), L.base_team(t).alias("base"), L.display_number(F.col("n"), t).alias("shown"))


@_query(f"WITH {P.BOX} SELECT image, det, (x2 - x1) * 0.5::DOUBLE > 2 AND (y2 - y1) * 0.4::DOUBLE > 2 AND (x2 - x1) * 0.5::DOUBLE * ((y2 - y1) * 0.4::DOUBLE) / ((x2 - x1) * (y2 - y1) + 1e-16::DOUBLE) > 0.1::DOUBLE AND greatest((x2 - x1) * 0.5::DOUBLE / ((y2 - y1) * 0.4::DOUBLE + 1e-16::DOUBLE), (y2 - y1) * 0.4::DOUBLE / ((x2 - x1) * 0.5::DOUBLE + 1e-16::DOUBLE)) < 100 AS ok FROM box")
def plausible_boxes(spark, d):
    x1, y1, x2, y2 = boxes.box()
    w, h = (x2 - x1) * 0.5, (y2 - y1) * 0.4
    # the sides are given as they are, from a corner at 0, so that no rounding enters by the difference of corners
    zero = F.lit(0.0)
    return P.box(spark, d).select("image", "det", B.plausible((zero, zero, x2 - x1, y2 - y1), (zero, zero, w, h)).alias("ok"))
