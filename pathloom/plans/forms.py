"""Queries of the column functions: boxes, geometry, clocks, labels, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import geometry as G
from ..functions import labels as L
from ..functions import times as T
from ..operators import boxes, stats, tall
from . import proxies as P
from .catalog import _AREA, _INTER, _obs_sql, _query


def _round(columns, names, places: int = 6):
    return [F.round(c, places).alias(n) for c, n in zip(columns, names)]


@_query("SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])) / len(embedding), 6) AS m, CASE WHEN len(embedding[1 : vec_id % 3]) > 0 THEN round(list_sum(CAST(embedding[1 : vec_id % 3] AS DOUBLE[])) / (vec_id % 3), 6) END AS few FROM embeddings")
def row_means(spark, d):
    v = F.transform("embedding", lambda x: x.cast("double"))
    e = P.table(spark, d, "embeddings").select("vec_id", v.alias("v"), F.slice(v, F.lit(1), (F.col("vec_id") % 3).cast("int")).alias("few"))
    return e.select("vec_id", F.round(L.mean_of(F.col("v")), 6).alias("m"), F.round(L.mean_of(F.col("few")), 6).alias("few"))


@_query(f"WITH {P.BOX} SELECT image, det, round(greatest(0.0, least(x1 / 0.5::DOUBLE, 320.0)), 6) AS a, round(greatest(0.0, least((y1 - 20) / 0.5::DOUBLE, 240.0)), 6) AS b, round(greatest(0.0, least(x2 / 0.5::DOUBLE, 320.0)), 6) AS c, round(greatest(0.0, least((y2 - 20) / 0.5::DOUBLE, 240.0)), 6) AS e, round(greatest(0.0, least((x1 - 0) / 0.5::DOUBLE, 320.0)), 6) AS px, round(greatest(0.0, least((y2 - 20) / 0.5::DOUBLE, 240.0)), 6) AS py FROM box")
def unletterbox_boxes(spark, d):
    box = boxes.box()
    back = B.unletterbox(box, (160, 160), (320, 240))
    point = B.unletterbox_points(F.array(F.struct(F.col("x1").alias("x"), F.col("y2").alias("y"))), (160, 160), (320, 240))[0]
    return P.box(spark, d).select("image", "det", *_round([*back, point["x"], point["y"]], ("a", "b", "c", "e", "px", "py")))


_CLOSED = "[struct_pack(x := x1, y := y1), struct_pack(x := x2, y := y1), struct_pack(x := x2, y := y2), struct_pack(x := x1, y := y2)]"


@_query(f"""WITH {P.BOX}, p AS (SELECT image, det, list_filter({_CLOSED}, lambda q: q.x BETWEEN 0 AND 120 AND q.y BETWEEN 0 AND 120) AS k, [x1, x2, x2, x1, x1] AS xs, [y1, y1, y2, y2, y1] AS ys FROM box)
SELECT image, det, list_min(list_transform(k, lambda q: q.x)) AS a, list_min(list_transform(k, lambda q: q.y)) AS b, list_max(list_transform(k, lambda q: q.x)) AS c, list_max(list_transform(k, lambda q: q.y)) AS e,
 round(list_sum(list_transform(range(0, 7), lambda i: (i + 1) * (xs[CAST(least(floor(i * (4 / 6.0::DOUBLE)), 3) AS INTEGER) + 1] + (xs[CAST(least(floor(i * (4 / 6.0::DOUBLE)), 3) AS INTEGER) + 2] - xs[CAST(least(floor(i * (4 / 6.0::DOUBLE)), 3) AS INTEGER) + 1]) * (i * (4 / 6.0::DOUBLE) - least(floor(i * (4 / 6.0::DOUBLE)), 3))))), 5) AS sum_x FROM p""")
def polygon_boxes(spark, d):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    poly = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"))
    b = P.box(spark, d).withColumn("p", poly)
    weighted = F.aggregate(F.transform(B.resampled(F.col("p"), 7), lambda q, i: (i + 1) * q["x"]), F.lit(0.0), lambda s, v: s + v)
    return b.select("image", "det", *[c.alias(n) for c, n in zip(B.polygon_box(F.col("p"), 120, 120), ("a", "b", "c", "e"))], F.round(weighted, 5).alias("sum_x"))


_GROWN = "(x1 + x2) / 2 - (greatest(x2 - x1, y2 - y1) * 1.02::DOUBLE + 10) / 2"


@_query(f"WITH {P.BOX} SELECT image, det, round({_GROWN}, 6) AS a, round((y1 + y2) / 2 + ((y2 - y1) * 1.5::DOUBLE + 4) / 2, 6) AS b, round(greatest(0.0, least(x1 + (x2 - x1) * 0.2::DOUBLE, 100.0)), 6) AS c, round(greatest(0.0, least(y1 + (y2 - y1) * 0.6::DOUBLE, 90.0)), 6) AS e FROM box")
def crop_boxes(spark, d):
    box = boxes.box()
    return P.box(spark, d).select("image", "det", *_round([B.expand(box, square=True)[0], B.expand(box, 1.5, 4.0)[3], B.sub_rectangle(box, 0.2, 0.1, 0.8, 0.6, 100, 90)[0], B.sub_rectangle(box, 0.2, 0.1, 0.8, 0.6, 100, 90)[3]], ("a", "b", "c", "e")))


@_query(f"WITH {P.BOX} SELECT image, det, unnest(['xyxy', 'xywh', 'xyxyn', 'xywhn']) AS form, unnest([round(x1, 6), round((x1 + x2) / 2, 6), round(x1 / 200, 6), round((x1 + x2) / 2 / 200, 6)]) AS a, unnest([round(y2, 6), round(y2 - y1, 6), round(y2 / 150, 6), round((y2 - y1) / 150, 6)]) AS z FROM box")
def four_box_forms(spark, d):
    forms = B.four_forms(boxes.box(), 200.0, 150.0)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("form"), F.round(v[0], 6).alias("a"), F.round(v[3], 6).alias("z")) for n, v in forms.items()]))
    return P.box(spark, d).select("image", "det", rows.alias("f")).select("image", "det", "f.*")


@_query("SELECT vec_id, list_resize(CAST(embedding[1 : vec_id % 6] AS DOUBLE[]), 4) IS NOT NULL AS ok, CAST(list_count(list_resize(CAST(embedding[1 : vec_id % 6] AS DOUBLE[]), 4)) AS BIGINT) AS filled FROM embeddings")
def fitted_lengths(spark, d):
    cut = F.slice("embedding", F.lit(1), (F.col("vec_id") % 6).cast("int"))
    e = P.table(spark, d, "embeddings").select("vec_id", L.fit_length(cut, 4).alias("v"))
    return e.select("vec_id", (F.size("v") == 4).alias("ok"), F.size(F.array_compact("v")).cast("long").alias("filled"))


@_query(_obs_sql("SELECT event_id, x AS a, y AS b, x + 1 AS c FROM obs"))
def parsed_points(spark, d):
    text = F.concat(F.lit("  "), F.col("x").cast("string"), F.lit(","), F.col("y").cast("string"), F.lit("   "), (F.col("x") + 1).cast("string"), F.lit(",0 "))
    p = P.obs(spark, d).withColumn("p", G.parse_points(text))
    return p.select("event_id", F.col("p")[0]["x"].alias("a"), F.col("p")[0]["y"].alias("b"), F.col("p")[1]["x"].alias("c"))


@_query(_obs_sql("SELECT event_id, entity, rn FROM (SELECT *, floor((min(rn) OVER w + max(rn) OVER w) / 2.0) AS m FROM obs WINDOW w AS (PARTITION BY entity)) WHERE rn BETWEEN m - 4 AND m"))
def central_window(spark, d):
    return tall.centre_span(P.obs(spark, d), ["entity"], "rn", 4).select("event_id", "entity", "rn")


@_query(_obs_sql("SELECT event_id, rn - max(CASE WHEN x = best THEN rn END) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING) >= 6 AS stop FROM (SELECT *, max(x) OVER (PARTITION BY entity ORDER BY rn ROWS UNBOUNDED PRECEDING) AS best FROM obs)"))
def early_stop(spark, d):
    return tall.patience(P.obs(spark, d), ["entity"], "rn", "x", 6).select("event_id", "stop")


@_query("SELECT doc_id, start, least(start + 300, n_chars) AS \"end\" FROM (SELECT doc_id, n_chars, unnest(range(0, greatest(n_chars - 1, 0) + 1, 300)) AS start FROM documents)")
def tumbling_chunks(spark, d):
    return tall.tumbling(P.table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", 300).select("doc_id", "start", "end")


@_query(_obs_sql("""SELECT event_id, round(degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (ux * vx + uy * vy) / (sqrt(ux * ux + uy * uy) * sqrt(vx * vx + vy * vy) + 1e-6::DOUBLE))))), 4) AS angle FROM (
 SELECT event_id, lag(x) OVER w - x AS ux, lag(y) OVER w - y AS uy, lead(x) OVER w - x AS vx, lead(y) OVER w - y AS vy FROM obs WINDOW w AS (PARTITION BY entity ORDER BY rn)) WHERE ux IS NOT NULL AND vx IS NOT NULL"""))
def joint_angles(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("entity").orderBy("rn")
    o = P.obs(spark, d).withColumns({f"{c}{s}": f(c).over(w) for c in "xy" for s, f in (("0", F.lag), ("2", F.lead))}).filter("x0 is not null and x2 is not null")
    return o.select("event_id", F.round(G.joint_angle(*map(F.col, ("x0", "y0", "x", "y", "x2", "y2"))), 4).alias("angle"))


_WX = lambda x, y: f"(2 * {x} + 10) / (0.01::DOUBLE * {y} + 1)"
_WY = lambda x, y: f"(3 * {y} - 5) / (0.01::DOUBLE * {y} + 1)"
_CORNERS = [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")]


@_query(f"WITH {P.BOX} SELECT image, det, " + ", ".join(f"round({f}({', '.join(w(x, y) for x, y in _CORNERS)}), 6) AS {n}" for n, f, w in (("a", "least", _WX), ("b", "least", _WY), ("c", "greatest", _WX), ("e", "greatest", _WY))) + " FROM box")
def warped_boxes(spark, d):
    return P.box(spark, d).select("image", "det", *_round(G.warp_box([2, 0, 10, 0, 3, -5, 0, 0.01, 1], *boxes.box()), ("a", "b", "c", "e")))


@_query(_obs_sql("SELECT event_id, x > 100 AND x < 300 AND y > 20 AND y < 80 AS inside FROM obs"))
def inside_rectangle(spark, d):
    corners = [(F.lit(a), F.lit(b)) for a, b in ((100.0, 20.0), (300.0, 20.0), (300.0, 80.0), (100.0, 80.0))]
    return P.obs(spark, d).select("event_id", G.inside_polygon(F.col("x"), F.col("y"), corners).alias("inside"))


@_query("""WITH m AS (SELECT vec_id, list_transform(embedding, lambda v: CASE WHEN v > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a, list_transform(embedding, lambda v: CASE WHEN v > -0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS b FROM embeddings)
SELECT vec_id, round(i / (list_sum(a) + list_sum(b) - i + 1e-7::DOUBLE), 6) AS iou FROM (SELECT *, list_sum(list_transform(range(1, len(a) + 1), lambda k: a[k] * b[k])) AS i FROM m)""")
def mask_ious(spark, d):
    bits = lambda low: F.transform("embedding", lambda v: F.when(v.cast("double") > low, 1.0).otherwise(0.0))
    return P.table(spark, d, "embeddings").select("vec_id", F.round(G.mask_iou(bits(0.0), bits(-0.05)), 6).alias("iou"))


_PAIR_IOU = f"({_INTER} / ({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE))"
_UNION = f"({_AREA('a')} + {_AREA('b')} - {_INTER} + 1e-7::DOUBLE)"
_CW, _CH = "(greatest(a.x2, b.x2) - least(a.x1, b.x1))", "(greatest(a.y2, b.y2) - least(a.y1, b.y1))"
_FAR = f"(((a.x1 + a.x2 - b.x1 - b.x2) / 2) * ((a.x1 + a.x2 - b.x1 - b.x2) / 2) + ((a.y1 + a.y2 - b.y1 - b.y2) / 2) * ((a.y1 + a.y2 - b.y1 - b.y2) / 2)) / ({_CW} * {_CW} + {_CH} * {_CH} + 1e-7::DOUBLE)"
_SHAPE = "(4 / (pi() * pi()) * power(atan((a.x2 - a.x1) / (a.y2 - a.y1 + 1e-7::DOUBLE)) - atan((b.x2 - b.x1) / (b.y2 - b.y1 + 1e-7::DOUBLE)), 2))"


@_query(f"""WITH {P.BOX} SELECT a.image, a.det AS a, b.det AS b, round({_PAIR_IOU} - ({_CW} * {_CH} + 1e-7::DOUBLE - {_UNION}) / ({_CW} * {_CH} + 1e-7::DOUBLE), 5) AS giou, round({_PAIR_IOU} - {_FAR}, 5) AS diou,
 round({_PAIR_IOU} - ({_FAR} + {_SHAPE} * {_SHAPE} / ({_SHAPE} - {_PAIR_IOU} + 1 + 1e-7::DOUBLE)), 5) AS ciou,
 round({_PAIR_IOU} - ((a.x1 - b.x1) * (a.x1 - b.x1) + (a.y1 - b.y1) * (a.y1 - b.y1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.y2 - b.y2) * (a.y2 - b.y2)) / (150.0 * 150.0 + 150.0 * 150.0), 5) AS mpdiou
FROM box a JOIN box b ON a.image = b.image AND b.det = a.det + 1""")
def iou_kinds(spark, d):
    b = P.box(spark, d)
    one = b.select("image", F.col("det").alias("a"), *[F.col(c).alias(f"a_{c}") for c in boxes.BOX])
    two = b.select("image", F.col("det").alias("b"), (F.col("det") - 1).alias("a"), *[F.col(c).alias(f"b_{c}") for c in boxes.BOX])
    j = one.join(two, ["image", "a"])
    return j.select("image", "a", "b", *[F.round(B.iou(boxes.box("a_"), boxes.box("b_"), k, 150.0, 150.0), 5).alias(k) for k in ("giou", "diou", "ciou", "mpdiou")])


@_query(_obs_sql("""SELECT event_id, sec % 86400 AS seconds, 125 AS ahead, printf('%02d:%02d:%06.3f', CAST(floor((frame % 90000) / 29.97::DOUBLE / 3600) AS BIGINT), CAST(floor((frame % 90000) / 29.97::DOUBLE / 60) AS BIGINT) % 60, (frame % 90000) / 29.97::DOUBLE - floor((frame % 90000) / 29.97::DOUBLE / 60) * 60) AS clock,
 epoch_us(TIMESTAMP '2025-02-08 09:39:00') + CAST(round((frame % 90000) / 29.97::DOUBLE * 1000000) AS BIGINT) AS instant, epoch_us(TIMESTAMP '2025-02-08 17:39:00' - INTERVAL 8 HOUR) AS shifted, greatest(frame % 500 - 75, 0) AS a, least(frame % 500 + 10 + 75, 480) AS b FROM obs"""))
def clock_forms(spark, d):
    text = F.format_string("%02d:%02d:%02d", F.floor(F.col("sec") % 86_400 / 3600), F.floor(F.col("sec") % 3600 / 60), F.col("sec") % 60)
    f = F.col("frame") % 90_000
    start = F.lit("2025-02-08 09:39:00").cast("timestamp")
    a, b = T.padded(F.col("frame") % 500, F.col("frame") % 500 + 10, F.lit(480))
    ahead = T.clock_offsets(F.lit("09:58:55"), F.lit("10:01:00")).cast("int")
    local = F.unix_micros(T.local_timestamp(F.lit("2025-02-08 17:39:00")))
    return P.obs(spark, d).select("event_id", T.clock_seconds(text).alias("seconds"), ahead.alias("ahead"), T.frame_clock(f).alias("clock"), F.unix_micros(T.frame_timestamp(f, start)).alias("instant"), local.alias("shifted"), a.alias("a"), b.alias("b"))


@_query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') ELSE 'clip' || CAST(event_id % 10000 AS VARCHAR) END AS grp, CASE WHEN event_id % 2 = 0 THEN user_id % 7 + 1 ELSE 0 END AS part FROM events")
def chapter_names(spark, d):
    e = P.table(spark, d, "events")
    name = F.when(F.col("event_id") % 2 == 0, F.format_string("gx%02d%04d.MP4", F.col("user_id") % 7 + 1, F.col("event_id") % 10_000)).otherwise(F.concat(F.lit("clip"), (F.col("event_id") % 10_000).cast("string"), F.lit(".mp4")))
    group, part = T.chapter(name)
    return e.select("event_id", group.alias("grp"), part.cast("long").alias("part"))


@_query("SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'ball' WHEN value >= 200 THEN 'a' ELSE 'b' END AS best, CASE WHEN user_id % 4 = 0 THEN 'x_y_z_1' ELSE 'plain' END AS clean, round(0.1::DOUBLE * value + 0.9::DOUBLE * user_id, 6) AS fitness FROM events")
def label_scalars(spark, d):
    e = P.table(spark, d, "events")
    empty = F.create_map().cast("map<string,double>")
    scores = F.when(F.col("user_id") % 4 == 0, empty).otherwise(F.create_map(F.lit("a"), F.col("value"), F.lit("b"), F.lit(400.0) - F.col("value")))
    text = F.when(F.col("user_id") % 4 == 0, "x|y@z;1").otherwise("plain")
    return e.select("event_id", L.map_argmax(scores).alias("best"), L.clean_name(text).alias("clean"), F.round(L.fitness(F.col("value"), F.col("user_id")), 6).alias("fitness"))


@_query("""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN '1,2' ELSE '2,1,2' END AS ctc, CASE WHEN user_id % 2 = 0 THEN '1' ELSE '1,2' END AS ids, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 2 END AS kept, '1' AS first_91 FROM events""")
def token_decodes(spark, d):
    e = P.table(spark, d, "events")
    even = F.col("user_id") % 2 == 0
    raw = F.when(even, F.array(*map(F.lit, (0, 1, 1, 0, 2, 2)))).otherwise(F.array(*map(F.lit, (2, 2, 1, 0, 0, 2))))
    p = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    rows = F.when(even, F.array(p(0.1, 0.8, 0.1), p(0.9, 0.05, 0.05), p(0, 0, 1))).otherwise(F.array(p(0.1, 0.8, 0.1), p(0.2, 0.1, 0.7)))
    ids, probs = L.greedy_decode(rows)
    joined = lambda a: F.array_join(F.transform(a, lambda v: v.cast("string")), ",")
    return e.select("event_id", joined(L.ctc_collapse(raw)).alias("ctc"), joined(ids).alias("ids"), F.size(probs).alias("kept"), L.class_91(F.lit(0)).cast("string").alias("first_91"))


@_query("SELECT n AS cls, CAST(CASE WHEN n <= 10 THEN n + 1 WHEN n <= 23 THEN n + 2 WHEN n <= 25 THEN n + 3 WHEN n <= 39 THEN n + 5 WHEN n <= 59 THEN n + 6 WHEN n = 60 THEN 67 WHEN n = 61 THEN 70 WHEN n <= 72 THEN n + 10 ELSE n + 11 END AS BIGINT) AS number FROM (SELECT CAST(p_partkey % 80 AS BIGINT) AS n FROM part GROUP BY 1)")
def class_renumbering(spark, d):
    c = P.table(spark, d, "part").select((F.col("p_partkey") % 80).cast("long").alias("cls")).distinct()
    return c.select("cls", L.class_91(F.col("cls")).cast("long").alias("number"))


@_query(f"""WITH {P.BOX} SELECT image, string_agg(CAST(n AS VARCHAR) || ' ' || cls || CASE WHEN n > 1 THEN 's' ELSE '' END, ', ' ORDER BY cls) AS text FROM (SELECT image, cls, count(*) AS n FROM box GROUP BY ALL) GROUP BY image""")
def class_count_texts(spark, d):
    c = P.box(spark, d).groupBy("image", F.col("cls").alias("name")).agg(F.count("*").alias("n"))
    return c.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("name", "n"))).alias("c")).select("image", L.class_counts(F.col("c")).alias("text"))


_HB = "least(greatest(CAST(floor({v} / ({top} / {n}.0::DOUBLE)) AS INTEGER), 0), {n} - 1)"


@_query(f"""WITH {P.BOX}, c AS MATERIALIZED (SELECT *, {_HB.format(v='x1', top='100.0::DOUBLE', n=10)} AS i, {_HB.format(v='y1', top='100.0::DOUBLE', n=10)} AS j FROM box), g AS MATERIALIZED (SELECT i, j, count(*) AS n, avg(y2 - y1) AS h FROM c GROUP BY i, j)
SELECT c.image, c.det, round(ln(CAST(g.n AS DOUBLE)), 6) AS density, round(g.h, 7) AS expected, round(CASE WHEN abs(y2 - y1 - h) > 0.2::DOUBLE * h THEN y2 - h ELSE y1 END, 7) AS top FROM c JOIN g USING (i, j)""")
def height_corrections(spark, d):
    b = P.box(spark, d)
    i, j = G.bin_index(F.col("x1"), 0.0, 100.0, 10), G.bin_index(F.col("y1"), 0.0, 100.0, 10)
    c = b.withColumn("i", i).withColumn("j", j)
    c = c.join(stats.mean_height_grid(b, 100.0, 100.0, 10, 10), ["i", "j"])
    return c.select("image", "det", F.round(G.log_density(F.col("n")), 6).alias("density"), F.round("height", 7).alias("expected"), F.round(B.height_corrected(boxes.box(), F.col("height"))[1], 7).alias("top"))
