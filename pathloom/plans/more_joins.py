"""Queries of joins over intervals, positions and names, and of statistics that need more than one grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import boxes, joins, stats, tall
from . import proxies as P
from .catalog import _AREA, _INTER, _SPEED, _obs_sql, _query


@_query("WITH " + P.SEG + """, ch AS (SELECT entity, (start // 200) AS chapter, (start // 200) * 200 AS g_start, (start // 200) * 200 + 200 AS g_end FROM seg GROUP BY ALL)
SELECT s.id, c.chapter, greatest(s.start, c.g_start) - c.g_start AS local_start, least(s."end", c.g_end) - c.g_start AS local_end FROM seg s JOIN ch c ON c.entity = s.entity AND s.start < c.g_end AND c.g_start < s."end" """)
def window_chapter_parts(spark, d):
    s = P.seg(spark, d)
    ch = s.select("entity", F.floor(F.col("start") / 200).alias("chapter")).distinct().select("entity", "chapter", (F.col("chapter") * 200).alias("g_start"), (F.col("chapter") * 200 + 200).alias("g_end"))
    return joins.window_parts(s.select("id", "entity", "start", "end"), ch, ["entity"], 64).select("id", "chapter", "local_start", "local_end")


@_query("WITH c AS (SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM conversations) SELECT conv_id, turn, CAST(g + turn * 2 AS BIGINT) AS global_frame FROM c")
def local_to_global(spark, d):
    c = P.table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    chapters = tall.running_offset(c, ["conv_id"], "turn", "n", "g_start")
    return joins.to_global(c.withColumn("f", F.col("turn") * 2), chapters, ["conv_id", "turn"], "f").select("conv_id", "turn", F.col("global_frame").cast("long").alias("global_frame"))


@_query("SELECT a.c_custkey AS named, b.c_custkey AS owing FROM (SELECT *, row_number() OVER (ORDER BY c_name) AS p FROM customer) a JOIN (SELECT *, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS p FROM customer) b USING (p)")
def positional_zip_whole(spark, d):
    c = P.table(spark, d, "customer")
    named, owing = c.select(F.col("c_custkey").alias("named"), "c_name"), c.select(F.col("c_custkey").alias("owing"), F.struct("c_acctbal", "c_custkey").alias("o"))
    return joins.by_position(named, owing, "c_name", "o").select("named", "owing")


@_query(f"""WITH {P.BOX} SELECT a.image, a.det FROM box a WHERE a.det % 2 = 1 AND NOT EXISTS (SELECT 1 FROM box b WHERE b.image = a.image AND b.det % 2 = 0 AND {_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE) > 0.1::DOUBLE)""")
def unmatched_detections(spark, d):
    b = P.box(spark, d)
    tracks = b.filter("det % 2 = 0").select("image", *[F.col(c).alias(f"t_{c}") for c in boxes.BOX])
    return joins.unmatched(b.filter("det % 2 = 1"), tracks, ["image"], "det", B.iou(boxes.box(), boxes.box("t_")), 0.1).select("image", "det")


@_query("""WITH v AS (SELECT DISTINCT 'clip' || CAST(p_partkey % 50 AS VARCHAR) || '_' AS video FROM part), f AS (SELECT 'clip' || CAST(p_partkey % 50 AS VARCHAR) || '_' || CASE WHEN p_partkey % 3 = 0 THEN 'tracks' ELSE 'raw' END || CAST(p_size AS VARCHAR) || '.jsonl' AS name, p_partkey AS changed FROM part)
SELECT video, name FROM (SELECT v.video, f.name, row_number() OVER (PARTITION BY v.video ORDER BY length(f.name), f.changed DESC, f.name) AS r FROM v JOIN f ON starts_with(f.name, v.video) AND contains(f.name, 'tracks')) WHERE r = 1""")
def sidecar_files(spark, d):
    stem = F.concat(F.lit("clip"), (F.col("p_partkey") % 50).cast("string"), F.lit("_"))
    p = P.table(spark, d, "part").withColumn("video", stem)
    f = p.select(F.concat("video", F.when(F.col("p_partkey") % 3 == 0, "tracks").otherwise("raw"), F.col("p_size").cast("string"), F.lit(".jsonl")).alias("name"), F.col("p_partkey").alias("changed"))
    return joins.sidecars(p.select("video").distinct(), f, "video", "name", "tracks", "changed")


@_query("SELECT page_id, '/data/images/x/labels/' || CAST(page_id AS VARCHAR) || '.b.txt' AS label FROM pages")
def label_paths(spark, d):
    p = P.table(spark, d, "pages")
    return p.select("page_id", joins.label_path(F.concat(F.lit("/data/images/x/images/"), F.col("page_id").cast("string"), F.lit(".b.jpg"))).alias("label"))


_TWO_STAGE = "q AS (SELECT *, count(*) OVER (PARTITION BY entity) AS n, row_number() OVER (PARTITION BY entity ORDER BY rn) AS i FROM v), e AS (SELECT entity, count(*) AS n," + ",".join(
    f"{f.format(c=c, w='')} AS {name}, {f.format(c=c, w=' FILTER (i <= floor(n * 0.5::DOUBLE))')} AS {name}_1, {f.format(c=c, w=' FILTER (i > floor(n * 0.5::DOUBLE))')} AS {name}_2" for name, f, c in (("distance", "sum({c}){w}", "metres"), ("avg_speed", "avg({c}){w}", "kmh"), ("max_speed", "max({c}){w}", "kmh"), ("min_speed", "quantile_cont({c}, 0.1){w}", "kmh"))
) + " FROM q GROUP BY entity)"
_RATIO = lambda c: f"round(avg(CASE WHEN n >= 4 AND {c}_1 > 0 THEN {c}_2 / {c}_1 END), 4) AS {c}_ratio"


@_query(_obs_sql("SELECT entity % 2 AS team, entity % 23 AS number, round(sum(distance), 3) AS distance, round(avg(avg_speed), 4) AS avg_speed, round(max(max_speed), 4) AS max_speed, round(min(min_speed), 4) AS min_speed, " + ", ".join(map(_RATIO, ("distance", "avg_speed", "max_speed", "min_speed"))) + " FROM e GROUP BY ALL", _SPEED, _TWO_STAGE))
def player_statistics(spark, d):
    o = P.obs(spark, d).withColumn("number", F.col("entity") % 23)
    s = stats.player_statistics(o, "team", "number")
    places = {"distance": 3}
    return s.select("team", "number", *[F.round(c, places.get(c, 4)).alias(c) for c in s.columns[2:]])


@_query(_obs_sql("SELECT team, entity, round(total, 4) AS total FROM (SELECT team, entity, coalesce(sum(CASE WHEN role <> 'error' THEN x END), 0) AS total FROM obs GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY team ORDER BY total DESC, entity) = 1"))
def keeper_choice(spark, d):
    o = P.obs(spark, d).withColumn("s", F.when(F.col("role") != "error", F.col("x")))
    return stats.keeper_track(o, ["team"], "entity", "s").withColumn("total", F.round("total", 4))


@_query("SELECT o_custkey, track, n FROM (SELECT o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN -1 ELSE o_orderkey % 4 END AS track, count(*) AS n FROM orders GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN track = -1 THEN 0 ELSE 1 END, n DESC, track) = 1")
def ball_choice(spark, d):
    t = P.table(spark, d, "orders").groupBy("o_custkey", F.when(F.col("o_orderkey") % 9 == 0, -1).otherwise(F.col("o_orderkey") % 4).alias("track")).agg(F.count("*").alias("n"))
    return stats.ball_track(t, ["o_custkey"], "track", "n")


@_query(_obs_sql("SELECT entity, CASE WHEN len(t) = 2 THEN array_to_string(list_sort(t), ',') ELSE array_to_string(t, ',') END AS teams FROM (SELECT entity, list(role ORDER BY r) AS t FROM (SELECT entity, role, row_number() OVER (PARTITION BY entity ORDER BY min(rn), role) AS r FROM obs GROUP BY entity, role) WHERE r <= 2 GROUP BY entity)"))
def team_discovery(spark, d):
    return stats.first_teams(P.obs(spark, d), ["entity"], "rn", "role").select("entity", F.array_join("teams", ",").alias("teams"))


@_query(_obs_sql("SELECT team, bin, round(n / CAST(sum(n) OVER (PARTITION BY team) AS DOUBLE), 8) AS share FROM (SELECT team, i * 30 + j * 6 + k AS bin, count(*) AS n FROM (SELECT team, least(greatest(CAST(floor(x / (490.0::DOUBLE / 10)) AS BIGINT), 0), 9) AS i, least(greatest(CAST(floor(y / (100.0::DOUBLE / 5)) AS BIGINT), 0), 4) AS j, entity % 6 AS k FROM obs WHERE x IS NOT NULL) GROUP BY ALL)"))
def colour_histograms(spark, d):
    h = stats.histogram(P.obs(spark, d).withColumn("k", (F.col("entity") % 6).cast("double")), ["team"], [("x", 490.0, 10), ("y", 100.0, 5), ("k", 6.0, 6)])
    return h.withColumn("share", F.round("share", 8))


@_query("SELECT event_type AS stage, round(sum(value), 4) AS seconds, CAST(sum(user_id % 3) AS BIGINT) AS items, round(CASE WHEN sum(user_id % 3) > 0 THEN sum(value) / sum(user_id % 3) ELSE 0 END, 6) AS each FROM events GROUP BY 1")
def stage_profile(spark, d):
    e = P.table(spark, d, "events").select(F.col("event_type").alias("stage"), "value", (F.col("user_id") % 3).alias("n"))
    return stats.profile(e, "stage", "value", "n").select("stage", F.round("seconds", 4).alias("seconds"), "items", F.round("each", 6).alias("each"))


@_query(_obs_sql("SELECT entity, count(*) AS n, round(coalesce(sum(d), 0), 4) AS length, round(max(x) - min(x), 4) AS width, round(max(y) - min(y), 4) AS height, round(quantile_cont(d, 0.5), 4) AS median_step FROM (SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS d FROM obs WINDOW w AS (PARTITION BY entity ORDER BY rn)) GROUP BY entity"))
def track_extents(spark, d):
    e = stats.extents(P.obs(spark, d), ["entity"], "rn")
    return e.select("entity", "n", *[F.round(c, 4).alias(c) for c in ("length", "width", "height", "median_step")])


@_query("SELECT CAST(sum(n) AS BIGINT) AS samples, round(sum(c) / CAST(sum(n) AS DOUBLE), 8) AS accuracy, round(1 - sum(ned) / sum(n), 8) AS ned, round(sum(loss * n) / sum(n), 6) AS loss FROM (SELECT o_custkey % 16 + 1 AS n, (o_custkey % 16 + 1) // 2 AS c, (o_custkey % 5) / 5.0::DOUBLE AS ned, o_totalprice / 1000 AS loss FROM orders)")
def epoch_totals(spark, d):
    n = F.col("o_custkey") % 16 + 1
    o = P.table(spark, d, "orders").select(n.alias("n"), F.floor(n / 2).alias("c"), ((F.col("o_custkey") % 5) / F.lit(5.0)).alias("ned"), (F.col("o_totalprice") / 1000).alias("loss"))
    t = stats.epoch_totals(o, "c", "ned", "loss", "n")
    return t.select("samples", F.round("accuracy", 8).alias("accuracy"), F.round("ned", 8).alias("ned"), F.round("loss", 6).alias("loss"))


@_query(_obs_sql("""SELECT event_id, round((list_sum([s[CAST(least(greatest(i + k, 0), n - 1) AS INTEGER) + 1] FOR k IN range(-h, h + 1)])) / (2 * h + 1), 5) AS smoothed FROM (
 SELECT *, (CAST(floor(round_even(n * 0.2::DOUBLE * 2, 0) / 2) AS BIGINT) + 1) // 2 AS h, list(x) OVER (PARTITION BY entity ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS s FROM (SELECT *, rn - 1 AS i, count(*) OVER (PARTITION BY entity) AS n FROM obs))"""))
def box_smooth(spark, d):
    return stats.box_smooth(P.obs(spark, d), ["entity"], "rn", "x", 0.2).select("event_id", F.round("smoothed", 5).alias("smoothed"))


@_query(_obs_sql("""SELECT entity, CAST(len(v) AS BIGINT) AS n, round(list_sum(v[1:5]) / len(v[1:5]), 5) AS first_mean, round(list_sum(t) / len(t), 5) AS last_mean, coalesce(len(list_filter(range(2, len(t) + 1), lambda i: t[i] < t[i - 1])) > 0, false) AS decreases FROM (SELECT entity, v, v[greatest(len(v) - 9, 1):len(v)] AS t FROM (SELECT entity, list(x ORDER BY rn) AS v FROM obs GROUP BY entity))"""))
def end_means(spark, d):
    e = stats.end_means(P.obs(spark, d), ["entity"], "rn", "x")
    return e.select("entity", "n", F.round("first_mean", 5).alias("first_mean"), F.round("last_mean", 5).alias("last_mean"), "decreases")


@_query("""WITH i AS (SELECT p_partkey AS image, (p_size % 20 + 5) / (p_partkey % 17 + 5.0::DOUBLE) AS ar FROM part), b AS (SELECT *, (row_number() OVER (ORDER BY ar, image) - 1) // 16 AS batch FROM i), s AS (SELECT batch, CASE WHEN max(ar) < 1 THEN max(ar) WHEN min(ar) > 1 THEN 1 / min(ar) ELSE 1 END AS shape FROM b GROUP BY batch)
SELECT image, batch, round(shape, 6) AS shape FROM b JOIN s USING (batch)""")
def aspect_batches(spark, d):
    i = P.table(spark, d, "part").select(F.col("p_partkey").alias("image"), ((F.col("p_size") % 20 + 5) / (F.col("p_partkey") % 17 + F.lit(5.0))).alias("ar"))
    return stats.aspect_batches(i, "image", "ar", 16).select("image", "batch", F.round("shape", 6).alias("shape"))


@_query("SELECT o_orderkey AS id, round(0.1::DOUBLE * o_totalprice + 0.9::DOUBLE * o_custkey, 4) AS fitness FROM orders ORDER BY 0.1::DOUBLE * o_totalprice + 0.9::DOUBLE * o_custkey DESC, o_orderkey LIMIT 5")
def fittest_rows(spark, d):
    top, _ = stats.fittest(P.table(spark, d, "orders").withColumnRenamed("o_orderkey", "id"), 0.1 * F.col("o_totalprice") + 0.9 * F.col("o_custkey"))
    return top.select("id", F.round("fitness", 4).alias("fitness"))


@_query("SELECT c_custkey, round(c_acctbal * 0.9::DOUBLE, 4) AS fitness, round(max(c_acctbal * 0.9::DOUBLE) OVER (ORDER BY c_custkey ROWS UNBOUNDED PRECEDING), 4) AS best FROM customer")
def evolution_log(spark, d):
    e = stats.evolution(P.table(spark, d, "customer"), "c_custkey", F.col("c_acctbal") * 0.9)
    return e.select("c_custkey", F.round("fitness", 4).alias("fitness"), F.round("best", 4).alias("best"))


@_query(f"WITH {P.BOX}, i AS (SELECT o_orderkey AS image FROM orders UNION SELECT image FROM box) SELECT count(*) AS images, count(*) FILTER (n IS NULL) AS unlabelled, CAST(coalesce(sum(n), 0) AS BIGINT) AS instances FROM i LEFT JOIN (SELECT image, count(*) AS n FROM box WHERE cls = 'A' GROUP BY image) USING (image)")
def unlabelled_images(spark, d):
    b = P.box(spark, d)
    images = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("image")).union(b.select("image")).distinct()
    n = b.filter("cls = 'A'").groupBy("image").agg(F.count("*").alias("n"))
    return images.join(n, "image", "left").agg(F.count("*").alias("images"), F.count_if(F.col("n").isNull()).alias("unlabelled"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("instances"))


@_query(f"WITH {P.BOX} SELECT cell_x, cell_y, n, round(height, 7) AS height FROM (SELECT least(greatest(CAST(floor(x1 / 10.0::DOUBLE) AS INTEGER), 0), 9) AS cell_x, least(greatest(CAST(floor(y1 / 10.0::DOUBLE) AS INTEGER), 0), 9) AS cell_y, count(*) AS n, avg(y2 - y1) AS height FROM box GROUP BY ALL)")
def mean_height_grid(spark, d):
    g = stats.mean_height_grid(P.box(spark, d), 100.0, 100.0, 10, 10)
    return g.select(F.col("i").alias("cell_x"), F.col("j").alias("cell_y"), "n", F.round("height", 7).alias("height"))


@_query(_obs_sql("SELECT event_id, last_value(CASE WHEN role = 'purchase' THEN x END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING) AS held FROM obs"))
def carry_forward(spark, d):
    o = P.obs(spark, d).withColumn("b", F.when(F.col("role") == "purchase", F.col("x")))
    return o.withColumn("held", tall.carry_forward("b", ["entity"], "rn")).select("event_id", "held")
