"""Queries of detection quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation
from . import proxies as P
from .catalog import _PAIRS, _matches, _query

_LEVELS = (0.1, 0.2, 0.3)
_TP = f"""{_PAIRS}, lv AS (SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE]) AS level), o AS (SELECT image, level, left_id, right_id, value FROM pr JOIN lv ON value >= level QUALIFY row_number() OVER (PARTITION BY image, level, left_id ORDER BY value DESC, right_id) = 1),
tp AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY image, level, right_id ORDER BY left_id) = 1)"""


def _hits(spark, d):
    """Detections (odd numbers) with a hit or none at each level, and the labels (even numbers) of each class."""
    b = P.box(spark, d)
    m = evaluation.matches(_matches(spark, d), ["image"], _LEVELS).select("image", "level", F.col("left_id").alias("det"), F.lit(True).alias("m"))
    dets = b.filter("det % 2 = 1").select("image", "det", "cls", (F.col("conf") / 110_000).alias("conf"), F.explode(F.array(*map(F.lit, _LEVELS))).alias("level"))
    s = dets.join(m, ["image", "level", "det"], "left").select("cls", "level", "conf", (F.col("image") * 10 + F.col("det")).alias("id"), F.coalesce("m", F.lit(False)).alias("hit"))
    return s, b.filter("det % 2 = 0").groupBy("cls").agg(F.count("*").alias("positives"))


_HITS = f"""{_TP}, s AS MATERIALIZED (SELECT b.cls, lv.level, b.conf / 110000 AS conf, b.image * 10 + b.det AS id, CASE WHEN tp.image IS NULL THEN 0 ELSE 1 END AS hit FROM box b CROSS JOIN lv LEFT JOIN tp ON tp.image = b.image AND tp.level = lv.level AND tp.left_id = b.det WHERE b.det % 2 = 1),
cv AS MATERIALIZED (SELECT q.*, tpn / (p.n + 1e-16::DOUBLE) AS recall, tpn / CAST(rank AS DOUBLE) AS precision FROM (SELECT cls, level, conf, row_number() OVER w AS rank, sum(hit) OVER (PARTITION BY cls, level ORDER BY conf DESC, id ROWS UNBOUNDED PRECEDING) AS tpn FROM s WINDOW w AS (PARTITION BY cls, level ORDER BY conf DESC, id)) q
 JOIN (SELECT cls, count(*) AS n FROM box WHERE det % 2 = 0 GROUP BY cls) p USING (cls)),
pt AS (SELECT cls, level, rank AS pos, recall, precision FROM cv UNION ALL SELECT DISTINCT cls, level, 0, 0.0, 1.0 FROM cv UNION ALL SELECT cls, level, max(rank) + 1, 1.0, 0.0 FROM cv GROUP BY cls, level),
en AS (SELECT *, max(precision) OVER (PARTITION BY cls, level ORDER BY pos DESC ROWS UNBOUNDED PRECEDING) AS env FROM pt),
nx AS (SELECT *, lead(recall) OVER (PARTITION BY cls, level ORDER BY pos) AS r2, lead(env) OVER (PARTITION BY cls, level ORDER BY pos) AS e2 FROM en),
g AS (SELECT i / 100.0::DOUBLE AS r FROM range(0, 101) t(i)),
ap AS (SELECT cls, level, sum((env + (e2 - env) * (r - recall) / (r2 - recall)) * CASE WHEN r = 0 OR r = 1 THEN 0.005 ELSE 0.01 END) AS ap FROM nx JOIN g ON r2 > recall AND r >= recall AND (r < r2 OR (r = 1 AND r2 >= 1)) GROUP BY cls, level)"""


@_query(f"WITH {_TP} SELECT image, level, left_id, right_id FROM tp")
def matches_by_level(spark, d):
    return evaluation.matches(_matches(spark, d), ["image"], _LEVELS).select("image", "level", "left_id", "right_id")


@_query(f"WITH {_HITS} SELECT cls, level, round(ap, 5) AS ap FROM ap")
def ap_by_level(spark, d):
    s, n = _hits(spark, d)
    return evaluation.average_precisions(evaluation.curves(s, ["cls", "level"], n), ["cls", "level"]).withColumn("ap", F.round("ap", 5))


#: Masks of 64 points, the signs of a vector's components: odd ids are detections, even ones labels, a label an image.
_MASKS = """WITH box AS (SELECT label AS image, vec_id AS det, CAST(vec_id % 3 AS VARCHAR) AS cls, CAST(1000 * (vec_id * 7919 % 97) AS DOUBLE) AS conf, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS m FROM embeddings),
pr AS (SELECT * FROM (SELECT a.image, a.det AS left_id, b.det AS right_id, list_sum(list_transform(range(1, 65), lambda i: a.m[i] * b.m[i])) / CAST(list_sum(list_transform(range(1, 65), lambda i: greatest(a.m[i], b.m[i]))) AS DOUBLE) AS value
 FROM box a JOIN box b ON a.image = b.image AND a.det % 2 = 1 AND b.det % 2 = 0 AND a.cls = b.cls) WHERE value >= 0.3)"""


def _mask_hits(spark, d):
    """Scored detections with a hit or none at each level, and the labels of each class, of the masks above."""
    from ..functions.geometry import packed_mask

    bits = F.transform("embedding", lambda x: F.when(x > 0, 1).otherwise(0))
    b = P.table(spark, d, "embeddings").select(F.col("label").alias("image"), F.col("vec_id").alias("det"), (F.col("vec_id") % 3).cast("string").alias("cls"), (1000 * (F.col("vec_id") * 7919 % 97)).cast("double").alias("conf"), packed_mask(bits).alias("mask"))
    labels = b.filter("det % 2 = 0")
    pairs = evaluation.best_mask_pairs(b.filter("det % 2 = 1"), labels.withColumnRenamed("det", "lab"), ["image", "cls"], 0.3)
    m = evaluation.matches(pairs, ["image"], (0.3, 0.4, 0.5)).select("image", "level", F.col("left_id").alias("det"), F.lit(True).alias("m"))
    dets = b.filter("det % 2 = 1").select("image", "det", "cls", (F.col("conf") / 110_000).alias("conf"), F.explode(F.array(*map(F.lit, (0.3, 0.4, 0.5)))).alias("level"))
    s = dets.join(m, ["image", "level", "det"], "left").select("cls", "level", "conf", (F.col("image") * 10 + F.col("det")).alias("id"), F.coalesce("m", F.lit(False)).alias("hit"))
    return s, labels.groupBy("cls").agg(F.count("*").alias("positives"))


@_query(_MASKS + _HITS[len(_PAIRS):].replace("[0.1::DOUBLE, 0.2::DOUBLE, 0.3::DOUBLE]", "[0.3::DOUBLE, 0.4::DOUBLE, 0.5::DOUBLE]") + " SELECT cls, level, round(ap, 5) AS ap FROM ap")
def mask_ap_by_level(spark, d):
    s, n = _mask_hits(spark, d)
    return evaluation.average_precisions(evaluation.curves(s, ["cls", "level"], n), ["cls", "level"]).withColumn("ap", F.round("ap", 5))


@_query(f"""WITH {_HITS}, lo AS MATERIALIZED (SELECT *, lead(conf) OVER w AS c2, lead(recall) OVER w AS r2, lead(precision) OVER w AS p2 FROM cv WHERE level < 0.15 WINDOW w AS (PARTITION BY cls ORDER BY conf DESC, rank)),
top AS (SELECT cls, max(conf) AS hi, min(conf) AS low, arg_max(recall, rank) AS rl, arg_max(precision, rank) AS pl FROM lo GROUP BY cls), gr AS (SELECT i, i / 100.0::DOUBLE AS x FROM range(0, 101) t(i)),
rd AS MATERIALIZED (SELECT cls, i, x, 0.0::DOUBLE AS recall, 1.0::DOUBLE AS precision FROM top JOIN gr ON x > hi UNION ALL SELECT cls, i, x, rl, pl FROM top JOIN gr ON x <= low
 UNION ALL SELECT cls, i, x, recall + (r2 - recall) * (conf - x) / (conf - c2), precision + (p2 - precision) * (conf - x) / (conf - c2) FROM (SELECT *, unnest(range(CAST(ceil(c2 * 100) AS BIGINT), CAST(floor(conf * 100) AS BIGINT) + 1)) AS i FROM lo WHERE c2 < conf) JOIN gr USING (i) WHERE x > c2 AND x <= conf),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-16::DOUBLE) AS f1 FROM rd), m AS (SELECT list(m ORDER BY i) AS v FROM (SELECT i, avg(f1) AS m FROM f GROUP BY i)),
b AS (SELECT k AS i FROM (SELECT unnest(range(0, 101)) AS k, v FROM m) ORDER BY round(list_sum([v[CAST(least(greatest(k + j, 0), 100) AS INTEGER) + 1] FOR j IN range(-3, 4)]) / 7, 12) DESC, k LIMIT 1)
SELECT cls, x AS conf, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f JOIN b USING (i)""")
def working_points(spark, d):
    s, n = _hits(spark, d)
    c = evaluation.curves(s.filter("level < 0.15"), ["cls"], n)
    p = evaluation.working_points(c, ["cls"], 101, 0.05)
    return p.select("cls", "conf", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")])


@_query()
def metric_bundle(spark, d):
    s, n = _hits(spark, d)
    return evaluation.metric_bundle(s, "cls", "level", n)


@_query(f"WITH {_HITS}, a AS (SELECT cls, avg(ap) AS ap FROM ap GROUP BY cls) SELECT c.cls, round(coalesce(a.ap, (SELECT avg(ap) FROM a)), 5) AS ap FROM (SELECT DISTINCT cls FROM box UNION SELECT 'Z') c LEFT JOIN a USING (cls)")
def class_map(spark, d):
    s, n = _hits(spark, d)
    by = evaluation.average_precisions(evaluation.curves(s, ["cls", "level"], n), ["cls", "level"]).groupBy("cls").agg(F.avg("ap").alias("ap"))
    bundle = by.unionByName(by.agg(F.lit(None).cast("string").alias("cls"), F.avg("ap").alias("ap")))
    classes = P.box(spark, d).select("cls").union(spark.createDataFrame([("Z",)], "cls string")).distinct()
    return evaluation.class_map(bundle, classes, "cls").withColumn("ap", F.round("ap", 5))


@_query(f"""WITH {_PAIRS}, sure AS (SELECT image, det, cls FROM box WHERE det % 2 = 1 AND conf > 25000), o AS (SELECT pr.* FROM pr JOIN sure ON sure.image = pr.image AND sure.det = pr.left_id WHERE value > 0.1 QUALIFY row_number() OVER (PARTITION BY pr.image, left_id ORDER BY value DESC, right_id) = 1),
m AS MATERIALIZED (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY image, right_id ORDER BY value DESC, left_id) = 1),
lab AS (SELECT image, det, cls FROM box WHERE det % 2 = 0)
SELECT truth, guess, count(*) AS n FROM (SELECT lab.cls AS truth, sure.cls AS guess FROM m JOIN sure ON sure.image = m.image AND sure.det = m.left_id JOIN lab ON lab.image = m.image AND lab.det = m.right_id
 UNION ALL SELECT cls, 'background' FROM lab WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.image = lab.image AND m.right_id = lab.det) UNION ALL SELECT 'background', cls FROM sure WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.image = sure.image AND m.left_id = sure.det)) GROUP BY ALL""")
def confusion_of_boxes(spark, d):
    b = P.box(spark, d)
    dets, labels = b.filter("det % 2 = 1"), b.filter("det % 2 = 0").withColumnRenamed("det", "lab")
    return evaluation.confusion_of_boxes(dets, labels, _matches(spark, d), ["image"], 25_000.0, 0.1)


@_query("""WITH r AS (SELECT event_id, event_type AS truth, ['view', 'click', CASE WHEN value > 200 THEN event_type ELSE 'view' END] AS ranked FROM events)
SELECT truth, count(*) AS n, round(avg(CASE WHEN ranked[1] = truth THEN 1.0::DOUBLE ELSE 0 END), 8) AS top1, round(avg(CASE WHEN list_contains(ranked, truth) THEN 1.0::DOUBLE ELSE 0 END), 8) AS topk FROM r GROUP BY GROUPING SETS ((truth), ())""")
def top_k_by_class(spark, d):
    ranked = F.array(F.lit("view"), F.lit("click"), F.when(F.col("value") > 200, F.col("event_type")).otherwise("view"))
    e = P.table(spark, d, "events").select(F.col("event_type").alias("truth"), ranked.alias("ranked"))
    return evaluation.top_k_by_class(e, "truth", "ranked", 3).select("truth", "n", F.round("top1", 8).alias("top1"), F.round("topk", 8).alias("topk"))


@_query("""WITH w AS (SELECT CAST(o_orderkey AS VARCHAR) AS t, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS g, o_totalprice / 1000 AS l FROM orders)
SELECT count(*) AS n, round(avg(CASE WHEN t = g THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy, round(1 - avg(levenshtein(t, g) / CAST(greatest(length(t), length(g)) AS DOUBLE)), 8) AS ned, round(avg(l), 6) AS loss FROM w""")
def word_accuracy(spark, d):
    o = P.table(spark, d, "orders")
    t, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    a = evaluation.word_accuracy(o, t, F.when(F.col("o_orderkey") % 3 == 0, t).otherwise(c), F.col("o_totalprice") / 1000)
    return a.select("n", F.round("accuracy", 8).alias("accuracy"), F.round("ned", 8).alias("ned"), F.round("loss", 6).alias("loss"))


@_query(f"""WITH {P.BOX} SELECT round(avg(CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0 END), 8) AS recall, round(avg(n), 8) AS past FROM (SELECT (CASE WHEN greatest(w / 10, 10 / w, h / 13, 13 / h) < 1.5 THEN 1 ELSE 0 END) + (CASE WHEN greatest(w / 30, 30 / w, h / 30, 30 / h) < 1.5 THEN 1 ELSE 0 END) AS n FROM (SELECT x2 - x1 AS w, y2 - y1 AS h FROM box))""")
def anchor_recall(spark, d):
    from ..operators import stats

    b = P.box(spark, d).select((F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    r = stats.recall_possible(b, [(10.0, 13.0), (30.0, 30.0)], 1.5)
    return r.select(F.round("recall", 8).alias("recall"), F.round("past", 8).alias("past"))
