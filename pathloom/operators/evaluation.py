"""Detection quality: matches at several overlaps, curves, the best working point, confusion with background, word accuracy.

Curves are keyed by the columns `by`, such as class and overlap level, so that all levels are one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import packed_iou
from ..session import ship
from ..storage import stored
from . import joins, stats

#: Overlaps from 0.5 to 0.95.
LEVELS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))


def matches(pairs: DataFrame, by: list[str], levels: tuple = LEVELS) -> DataFrame:
    """(by, level, left, right, value) of pairs (by, left_id, right_id, value) of equal class: at every level one-to-one, first the
    best label of each detection, then of each label the detection of the smallest number."""
    best = Window.partitionBy(*by, "left_id").orderBy(F.desc("value"), "right_id")  # whatever the level
    one = pairs.filter(F.col("value") >= min(levels)).withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")
    at = one.withColumn("level", F.explode(F.array(*map(F.lit, levels)))).filter(F.col("value") >= F.col("level"))
    first = Window.partitionBy(*by, "level", "right_id").orderBy("left_id")
    return at.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")


def curves(scored: DataFrame, by: list[str], positives: DataFrame, score: str = "conf", hit: str = "hit") -> DataFrame:
    """(by, rank, conf, tp, recall, precision) of rows in descending score; ties by `id`. `positives`: (by, positives), some of `by` suffice."""
    c = stats.ranked_hits(scored, by, score, hit).join(F.broadcast(positives), [x for x in positives.columns if x != "positives"])  # a row a class
    return c.select(*by, "rank", F.col(score).alias("conf"), "tp", (F.col("tp") / (F.col("positives") + 1e-16)).alias("recall"), (F.col("tp") / F.col("rank")).alias("precision"))


def average_precisions(curve: DataFrame, by: list[str]) -> DataFrame:
    """(by, ap): stats.average_precision() over several keys."""
    keyed = curve.withColumn("_key", F.struct(*by))
    return stats.average_precision(keyed, "_key").select("_key.*", "ap")


def working_points(curve: DataFrame, by: list[str], points: int = 1000, share: float = 0.1) -> DataFrame:
    """(by, conf, precision, recall, f1) at the one confidence where the smoothed mean F1 of all keys is greatest.

    Precision and recall are read at `points` confidences from 0 to 1 by straight lines between the curve's rows; above the highest
    confidence recall is 0 and precision 1, below the lowest the last row counts.
    """
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    # only rows beside one of the confidences are read, so the curve is summed up in a row for each that its rows lie above; of rows of one
    # confidence the last is what a reading from above sees
    low = F.floor(F.col("conf") * (points - 1))
    step = F.when(~F.isnan("conf"), F.when((low + 1) / (points - 1.0) <= F.col("conf"), low + 1).when(low / (points - 1.0) > F.col("conf"), low - 1).otherwise(low))
    sides = lambda f, s: [f(x, "rank").alias(f"_{x}{s}") for x in ("conf", "recall", "precision")]
    c = curve.withColumn("_s", step).groupBy(*by, "_s").agg(F.min("rank").alias("_a"), F.max("rank").alias("rank"), F.max("conf").alias("_top"), F.min("conf").alias("_low"), *sides(F.min_by, 1), *sides(F.max_by, 2))
    c = stored(c.drop("_s"), "curve-steps")
    top = c.groupBy(*by).agg(F.max("_top").alias("_top"), F.min("_low").alias("_low"), F.max_by("_recall2", "rank").alias("_rl"), F.max_by("_precision2", "rank").alias("_pl"))
    down = Window.partitionBy(*by).orderBy("_a")
    c = c.select(*by, F.col("_conf2").alias("conf"), F.col("_recall2").alias("recall"), F.col("_precision2").alias("precision"), *[F.lead(f"_{x}1").over(down).alias(n) for x, n in (("conf", "_next"), ("recall", "_r2"), ("precision", "_p2"))])
    at = top.withColumn("_i", grid).withColumn("x", F.col("_i") / (points - 1.0))
    above = at.filter("x > _top").select(*by, "_i", "x", F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    below = at.filter("x <= _low").select(*by, "_i", "x", F.col("_rl").alias("recall"), F.col("_pl").alias("precision"))
    step = F.explode(F.sequence(F.ceil(F.col("_next") * (points - 1)), F.floor(F.col("conf") * (points - 1))))
    between = c.filter("_next < conf").withColumn("_i", step).withColumn("x", F.col("_i") / (points - 1.0)).filter("x > _next AND x <= conf")
    line = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * (F.col("conf") - F.col("x")) / (F.col("conf") - F.col("_next"))
    between = between.select(*by, F.col("_i").cast("int").alias("_i"), "x", line("recall", "_r2").alias("recall"), line("precision", "_p2").alias("precision"))
    read = above.unionByName(below).unionByName(between).withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-16))
    mean = read.groupBy("_i").agg(F.avg("f1").alias("m")).withColumn("_one", F.lit(1))
    best = stats.box_smooth(mean, ["_one"], "_i", "m", share).orderBy(F.desc(F.round("smoothed", 12)), "_i").limit(1).select("_i")
    return read.join(F.broadcast(best), "_i").select(*by, F.col("x").alias("conf"), "precision", "recall", "f1")  # one row


def metric_bundle(scored: DataFrame, cls: str, level: str, positives: DataFrame) -> DataFrame:
    """(cls, precision, recall, ap50, ap) by class, with the means in a row of class null. Precision and recall are those of the
    lowest level's working point."""
    c = stored(curves(scored, [cls, level], positives), "curves")
    ap = stored(average_precisions(c, [cls, level]), "average-precisions")
    low = F.col(level) == F.lit(c.agg(F.min(level)).first()[0])
    ap50 = ap.filter(low).select(cls, F.col("ap").alias("ap50"))
    points = working_points(c.filter(low).drop(level), [cls]).select(cls, "precision", "recall")
    by = ap.groupBy(cls).agg(F.avg("ap").alias("ap")).join(ap50, cls, "left").join(points, cls, "left").select(cls, "precision", "recall", "ap50", "ap")
    mean = by.agg(F.lit(None).cast(by.schema[cls].dataType).alias(cls), *[F.avg(c).alias(c) for c in ("precision", "recall", "ap50", "ap")])
    return by.unionByName(mean.select(*by.columns))


def mask_pairs(detections: DataFrame, labels: DataFrame, on: list[str], least: float = 0.5) -> DataFrame:
    """(on, left_id, right_id, value): detections (on, det, mask) and labels (on, lab, mask) of one image whose packed masks have an
    intersection over union of `least` or more."""
    a = detections.select(*on, F.col("det").alias("left_id"), F.col("mask").alias("_a"))
    b = labels.select(*on, F.col("lab").alias("right_id"), F.col("mask").alias("_b"))
    return a.join(b, on).withColumn("value", packed_iou(F.col("_a"), F.col("_b"))).filter(F.col("value") >= least).select(*on, "left_id", "right_id", "value")


def best_mask_pairs(detections: DataFrame, labels: DataFrame, on: list[str], least: float = 0.5, block: int = 4096) -> DataFrame:
    """Of mask_pairs() the best of each detection, ties to the smaller label, without making the others: all of an image meet, but in blocks of
    about `block` detections and labels, a task each, from which a row a detection comes out."""
    ship(detections.sparkSession)
    of = F.struct(F.lit(0), *on)
    a = detections.filter(F.col("mask").isNotNull()).select(*on, F.col("det").alias("_id"), "mask")
    b = labels.filter(F.col("mask").isNotNull()).select(*on, F.col("lab").alias("_id"), "mask")
    for c in on:
        a, b = a.filter(F.col(c).isNotNull()), b.filter(F.col(c).isNotNull())
    sizes = lambda d, n: d.groupBy(of.alias("_of")).agg(F.ceil(F.count("*") / block).cast("int").alias(n))
    cells = stored(sizes(a, "_na").join(sizes(b, "_nb"), "_of"), "mask-blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("_id"), F.col(n)).cast("int")
    a = a.withColumn("_of", of).join(cells, "_of").withColumn("_a", own("_na")).withColumn("_b", every("_nb"))
    b = b.withColumn("_of", of).join(cells, "_of").withColumn("_b", own("_nb")).withColumn("_a", every("_na"))
    names = [*on, "_id", "mask", "_a", "_b"]
    schema = T.StructType([*[a.schema[c] for c in on], T.StructField("left_id", a.schema["_id"].dataType), T.StructField("right_id", b.schema["_id"].dataType), T.StructField("value", T.DoubleType())])

    def bits(table: pa.Table, words: int) -> tuple[pa.Table, np.ndarray]:
        table = table.filter(pc.equal(pc.list_value_length(table.column("mask")), words))
        flat = table.column("mask").combine_chunks().flatten().to_numpy().astype("<i8").view(np.uint8).reshape(len(table), words * 8)
        return table, np.unpackbits(flat, axis=1).astype(np.float32)

    def work(x: pa.Table, y: pa.Table) -> pa.Table:
        out = []
        y = y.sort_by("_id")
        for words in set(pc.list_value_length(x.column("mask")).to_pylist()) & set(pc.list_value_length(y.column("mask")).to_pylist()):
            (p, u), (q, v) = bits(x, words), bits(y, words)
            nu, nv = u.sum(1, dtype=float), v.sum(1, dtype=float)
            for k in range(0, len(u), 512):
                both = (u[k : k + 512] @ v.T).astype(float)  # whole numbers, exact
                either = nu[k : k + 512, None] + nv[None] - both
                value = np.divide(both, either, out=np.zeros_like(both), where=either > 0)
                at = value.argmax(1)  # the first of equals
                best = value[np.arange(len(at)), at]
                ok = np.flatnonzero(best >= least)
                some = p.slice(k, 512).take(pa.array(ok))
                out.append(pa.Table.from_arrays([*(some.column(c) for c in on), some.column("_id"), q.column("_id").take(pa.array(at[ok])), pa.chunked_array([pa.array(best[ok])])], schema.fieldNames()))
        none = [x.slice(0, 0).column(c) for c in (*on, "_id")] + [y.slice(0, 0).column("_id"), pa.chunked_array([pa.array([], pa.float64())])]
        return pa.concat_tables(out) if out else pa.Table.from_arrays(none, schema.fieldNames())

    a, b = (x.select(*[F.col(c).alias(f"{side}{c}") for c in names]) for x, side in ((a, "l"), (b, "r")))  # both may come from one table
    keys = lambda side: [f"{side}{c}" for c in (*on, "_a", "_b")]
    found = a.groupBy(*keys("l")).cogroup(b.groupBy(*keys("r"))).applyInArrow(lambda x, y: work(x.rename_columns(names), y.rename_columns(names)), schema)
    best = found.groupBy(*on, "left_id").agg(F.min(F.struct((-F.col("value")).alias("v"), "right_id")).alias("_m"))
    return best.select(*on, "left_id", "_m.right_id", (-F.col("_m.v")).alias("value"))


def box_and_mask_bundle(boxes: DataFrame, masks: DataFrame, cls: str, level: str, positives: DataFrame) -> DataFrame:
    """metric_bundle() of boxes and of masks side by side: (cls, box_precision, …, mask_ap), and fitness, 0.1 of either ap50 and 0.9 of either ap."""
    names = ("precision", "recall", "ap50", "ap")
    one, two = (metric_bundle(s, cls, level, positives).select(F.col(cls).alias(f"_{p}"), *[F.col(c).alias(f"{p}_{c}") for c in names]) for s, p in ((boxes, "box"), (masks, "mask")))
    both = one.join(two, F.col("_box").eqNullSafe(F.col("_mask")), "full_outer")
    part = lambda p: 0.1 * F.coalesce(f"{p}_ap50", F.lit(0.0)) + 0.9 * F.coalesce(f"{p}_ap", F.lit(0.0))
    return both.select(F.coalesce("_box", "_mask").alias(cls), *[f"{p}_{c}" for p in ("box", "mask") for c in names], (part("box") + part("mask")).alias("fitness"))


def class_map(bundle: DataFrame, classes: DataFrame, cls: str) -> DataFrame:
    """(cls, ap) for every class: its own, or the mean of all where it has none."""
    mean = bundle.filter(F.col(cls).isNull()).select(F.col("ap").alias("_m"))
    return classes.join(bundle.filter(F.col(cls).isNotNull()).select(cls, "ap"), cls, "left").crossJoin(F.broadcast(mean)).select(cls, F.coalesce("ap", "_m").alias("ap"))


def confusion_of_boxes(detections: DataFrame, labels: DataFrame, pairs: DataFrame, on: list[str], conf: float = 0.25, iou: float = 0.45) -> DataFrame:
    """(truth, guess, n) of boxes: detections (on, det, cls, conf) above `conf` and labels (on, lab, cls) meet one-to-one in `pairs`
    (on, left_id, right_id, value) above `iou`, the best of each detection, then of each label; what is left over meets the background."""
    sure = detections.filter(F.col("conf") > conf).select(*on, "det", F.col("cls").alias("guess"))
    p = pairs.filter(F.col("value") > iou).join(sure.select(*on, F.col("det").alias("left_id")), [*on, "left_id"], "left_semi")
    m = joins.best_pairs(p, on, "left_id", "right_id", "value").select(*on, F.col("left_id").alias("det"), F.col("right_id").alias("lab"))
    lab = labels.select(*on, "lab", F.col("cls").alias("truth"))
    both = m.join(sure, [*on, "det"]).join(lab, [*on, "lab"]).select("truth", "guess")
    missed = lab.join(m, [*on, "lab"], "left_anti").select("truth", F.lit(None).cast("string").alias("guess"))
    false = sure.join(m, [*on, "det"], "left_anti").select(F.lit(None).cast("string").alias("truth"), "guess")
    return stats.confusion(both.unionByName(missed).unionByName(false), "truth", "guess")


def top_k_by_class(df: DataFrame, truth: str, ranked: str, k: int = 5) -> DataFrame:
    """(truth, n, top1, topk) by class, with a row of class null for all."""
    one, some = (F.get(ranked, F.lit(0)) == F.col(truth)).cast("double"), F.array_contains(F.slice(ranked, 1, k), F.col(truth)).cast("double")
    return df.rollup(truth).agg(F.count("*").alias("n"), F.avg(one).alias("top1"), F.avg(some).alias("topk"))


def word_accuracy(df: DataFrame, truth: Column, guess: Column, loss: Column | None = None) -> DataFrame:
    """(n, accuracy, ned, loss): the share of equal words, 1 - mean edit distance over the longer length, the mean loss."""
    longest = F.greatest(F.length(truth), F.length(guess))
    far = F.when(longest == 0, 0.0).otherwise(F.levenshtein(truth, guess) / longest)
    more = [F.avg(loss).alias("loss")] if loss is not None else []
    return df.agg(F.count("*").alias("n"), F.avg((truth == guess).cast("double")).alias("accuracy"), (1 - F.avg(far)).alias("ned"), *more)
