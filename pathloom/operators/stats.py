"""Aggregates: votes, statistics, heat maps, rosters, evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import bin_index, distance
from ..storage import stored
from . import tall
from .numbering import numbered


def weighted_vote(df: DataFrame, by: list[str], label: str, score: Column, otherwise: str = "ball") -> DataFrame:
    """(by, label, score): the label with the largest sum of scores; ties to the smaller label, entities without any get `otherwise`."""
    sums = df.groupBy(*by, label).agg(F.sum(score).alias("score"))
    w = Window.partitionBy(*by).orderBy(F.desc("score"), label)
    top = sums.filter(F.col(label).isNotNull()).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    return df.select(*by).distinct().join(top, by, "left").withColumn(label, F.coalesce(F.col(label), F.lit(otherwise)))


def majority(df: DataFrame, by: list[str], value: str, accepted: Column, least: int) -> DataFrame:
    """(by, value, n, total): the most frequent accepted value, null unless it and all accepted ones number `least`; ties to the smaller."""
    counts = df.filter(accepted).groupBy(*by, value).agg(F.count("*").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    top = counts.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), value))).filter("_r = 1").drop("_r")
    enough = (F.col("n") >= least) & (F.col("total") >= least)
    out = df.select(*by).distinct().join(top, by, "left")
    return out.select(*by, F.when(enough, F.col(value)).alias(value), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"), F.when(F.col("n").isNull(), "N/A").when(enough, "known").otherwise("unsure").alias("state"))


def speed_statistics(points: DataFrame, by: list[str], stride: int = 5, fps: float = 29.97, unit: float = 0.1) -> DataFrame:
    """Distance and speed of each entity from every stride-th row: n, metres, mean, greatest and tenth-percentile km/h."""
    s = tall.sampled_speed(points, by, "frame", "rn", stride, fps, unit)
    return s.groupBy(*by).agg(F.count("*").alias("n"), F.sum("metres").alias("metres"), F.avg("kmh").alias("mean_kmh"), F.max("kmh").alias("max_kmh"), F.percentile("kmh", 0.1).alias("p10_kmh"))


def split_ratios(points: DataFrame, by: list[str], share: float = 0.5, stride: int = 5, fps: float = 29.97, unit: float = 0.1, least: int = 4) -> DataFrame:
    """Second part over first part, of mean speed and of distance a sample; null with fewer than `least` samples."""
    s = tall.sampled_speed(points, by, "frame", "rn", stride, fps, unit)
    w = Window.partitionBy(*by)
    s = s.withColumn("_n", F.count("*").over(w)).withColumn("_i", F.row_number().over(w.orderBy("rn")))
    first = F.col("_i") <= F.floor(F.col("_n") * share)
    part = lambda c, one: F.avg(F.when(first if one else ~first, F.col(c)))
    out = s.groupBy(*by).agg(F.count("*").alias("n"), part("kmh", True).alias("a"), part("kmh", False).alias("b"), part("metres", True).alias("c"), part("metres", False).alias("d"))
    fine = F.col("n") >= least
    return out.select(*by, "n", F.when(fine & (F.col("a") > 0), F.col("b") / F.col("a")).alias("speed_ratio"), F.when(fine & (F.col("c") > 0), F.col("d") / F.col("c")).alias("distance_ratio"))


def heat_bins(points: DataFrame, by: list[str], width: float, height: float, nx: int, ny: int) -> DataFrame:
    """(by, bx, by_, n): how often each cell of a grid was visited."""
    return points.select(*by, bin_index(F.col("x"), 0.0, width, nx).alias("cell_x"), bin_index(F.col("y"), 0.0, height, ny).alias("cell_y")).groupBy(*by, "cell_x", "cell_y").agg(F.count("*").alias("n"))


def gaussian_kernel(sigma: float = 1.5, reach: float = 4.0) -> list[float]:
    """Weights from -r to r that add up to 1."""
    from math import exp

    r = int(reach * sigma + 0.5)
    w = [exp(-0.5 * (i / sigma) ** 2) for i in range(-r, r + 1)]
    return [v / sum(w) for v in w]


def blur(cells: DataFrame, by: list[str], nx: int, ny: int, kernel: list[float]) -> DataFrame:
    """A separable blur of a sparse grid, cells outside reflected at the border: each cell is spread along x, then along y."""
    r = len(kernel) // 2
    weights = F.array(*[F.struct(F.lit(i - r).alias("d"), F.lit(k).alias("k")) for i, k in enumerate(kernel)])
    fold = lambda v, n: F.when(v < 0, -v - 1).when(v >= n, 2 * n - 1 - v).otherwise(v)
    out = cells.withColumn("v", F.col("n").cast("double"))
    for c, n in (("cell_x", nx), ("cell_y", ny)):
        spread = out.withColumn("_k", F.explode(weights))
        out = spread.withColumn(c, fold(F.col(c) + F.col("_k.d"), n)).groupBy(*by, "cell_x", "cell_y").agg(F.sum(F.col("v") * F.col("_k.k")).alias("v"))
    return out


def dense_cells(points: DataFrame, size: float, primary: int, secondary: int, radius: float) -> DataFrame:
    """Cells (cell_x, cell_y, n) that hold `primary` points or more, and those of `secondary` or more within `radius` of one."""
    cells = points.groupBy(F.floor(F.col("x") / size).alias("cell_x"), F.floor(F.col("y") / size).alias("cell_y")).agg(F.count("*").alias("n"))
    reach = int(radius / size)
    d = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    around = cells.filter(F.col("n") >= primary).select("cell_x", "cell_y").withColumn("dx", d).withColumn("dy", d)
    around = around.filter((F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) * size * size <= radius * radius).select((F.col("cell_x") + F.col("dx")).alias("cell_x"), (F.col("cell_y") + F.col("dy")).alias("cell_y")).distinct()
    near = cells.filter(F.col("n") >= secondary).join(around, ["cell_x", "cell_y"], "left_semi")
    return near.unionByName(cells.filter(F.col("n") >= primary)).distinct()


def without_dense(points: DataFrame, size: float, primary: int, secondary: int, radius: float) -> DataFrame:
    """The points that lie in no dense cell."""
    dense = dense_cells(points, size, primary, secondary, radius).select("cell_x", "cell_y")
    own = points.withColumn("cell_x", F.floor(F.col("x") / size)).withColumn("cell_y", F.floor(F.col("y") / size))
    return own.join(dense, ["cell_x", "cell_y"], "left_anti").drop("cell_x", "cell_y")


def path_length(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """(by, n, length)."""
    w = Window.partitionBy(*by).orderBy(order)
    d = distance(F.col("x"), F.col("y"), F.lag("x").over(w), F.lag("y").over(w))
    return points.withColumn("_d", d).groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("length"))


def size_violations(presence: DataFrame, frame: str, team: str, member: str, most: Column) -> DataFrame:
    """(frame, team, n, members): teams that have more members in a frame than `most` allows."""
    g = presence.groupBy(frame, team).agg(F.count_distinct(member).alias("n"), F.array_sort(F.collect_set(member)).alias("members"))
    return g.filter(F.col("n") > most)


def violation_windows(violations: DataFrame, frame: str, team: str, gap: int = 3) -> DataFrame:
    """Violations of the same team and number merged over gaps: (team, n, start, end, members)."""
    i = tall.islands(violations, [team, "n"], frame, gap)
    return i.groupBy(team, "n", "island").agg(F.min(frame).alias("start"), F.max(frame).alias("end"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("members")).drop("island")


def class_weights(df: DataFrame, cls: str) -> DataFrame:
    """(cls, n, weight): inverse frequencies that add up to 1."""
    c = df.groupBy(cls).agg(F.count("*").alias("n")).withColumn("_w", 1.0 / F.col("n"))
    return c.select(cls, "n", (F.col("_w") / F.sum("_w").over(Window.partitionBy(F.lit(1)))).alias("weight"))


def ranked_hits(df: DataFrame, by: list[str], score: str, hit: str) -> DataFrame:
    """Adds rank, from 1 by falling score, ties by `id`, and tp, the hits up to there. A class of any share of the rows lies in many ranges of
    scores, whose counts and hits before each come from a row a range."""
    placed = numbered(df.withColumn("_t", F.col(hit).cast("long")), by, [F.desc(score), "id"], "_p", ("_t", "tp"))
    return placed.withColumn("rank", F.col("_p") + 1).drop("_p", "_t")


def precision_recall(df: DataFrame, cls: str, score: str, hit: str, positives: DataFrame) -> DataFrame:
    """Curve rows (cls, rank, tp, fp, recall, precision) of scored rows; `positives`: (cls, positives). Rows tie by `id`."""
    c = ranked_hits(df, [cls], score, hit).join(F.broadcast(positives), cls)  # a row a class
    return c.select(cls, "rank", "tp", (F.col("rank") - F.col("tp")).alias("fp"), (F.col("tp") / (F.col("positives") + 1e-16)).alias("recall"), (F.col("tp") / F.col("rank")).alias("precision"))


def average_precision(curve: DataFrame, cls: str) -> DataFrame:
    """(cls, ap): the precision envelope read at 101 recalls by linear interpolation between curve points, by trapezoids.

    The curve begins at (0, 1) and ends at (1, 0) beyond its last recall. Of points with equal recall the
    last counts, as for interpolation on a sorted axis. Recall never falls along a curve, so only the points beside one of the 101 are read: the
    curve is summed up in a row for each recall that a point lies before, and the envelope goes over those rows.
    """
    up = F.ceil(F.col("recall") * 100)
    step = F.when(F.col("recall") >= 1, F.when(F.col("recall") > 1, 102).otherwise(101)).when(F.col("recall") <= (up - 1) / 100.0, up - 1).when(F.col("recall") > up / 100.0, up + 1).otherwise(up)
    pts = curve.select(cls, F.col("rank").alias("pos"), "recall", "precision", step.alias("_s")).groupBy(cls, "_s")
    pts = pts.agg(F.min("pos").alias("pos"), F.max("pos").alias("_z"), F.min_by("recall", "pos").alias("_r1"), F.max_by("recall", "pos").alias("recall"), F.max_by("precision", "pos").alias("precision"), F.max("precision").alias("_top"))
    pts = stored(pts.drop("_s"), "curves")
    ends = pts.groupBy(cls).agg(F.max("_z").alias("m"))
    edge = lambda pos, recall, precision: ends.select(cls, pos.cast("long").alias("pos"), F.lit(recall).alias("_r1"), F.lit(recall).alias("recall"), F.lit(precision).alias("precision"), F.lit(precision).alias("_top"))
    pts = pts.drop("_z").unionByName(edge(F.lit(0), 0.0, 1.0)).unionByName(edge(F.col("m") + 1, 1.0, 0.0)).withColumn("_q", -F.col("pos"))
    later = Window.partitionBy(cls).orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    pts = pts.withColumn("next_env", F.max("_top").over(later)).withColumn("next_recall", F.lag("_r1").over(Window.partitionBy(cls).orderBy("_q")))
    pts = pts.withColumn("env", F.greatest("precision", "next_env")).filter("next_recall > recall")
    # the recalls from this point to the next; at 1 the last one counts
    grid = F.explode(F.sequence(F.ceil(F.col("recall") * 100 - 1e-6), F.floor(F.col("next_recall") * 100 + 1e-6)))
    read = pts.withColumn("i", grid).withColumn("r", F.col("i") / 100.0)
    read = read.filter((F.col("r") >= F.col("recall")) & ((F.col("r") < F.col("next_recall")) | ((F.col("r") == 1.0) & (F.col("next_recall") >= 1.0))))
    read = read.withColumn("p", F.col("env") + (F.col("next_env") - F.col("env")) * (F.col("r") - F.col("recall")) / (F.col("next_recall") - F.col("recall")))
    weight = F.when((F.col("r") == 0.0) | (F.col("r") == 1.0), 0.005).otherwise(0.01)
    return read.groupBy(cls).agg(F.sum(F.col("p") * weight).alias("ap"))


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """(truth, guess, n); null stands for background on either side."""
    return df.select(F.coalesce(F.col(truth).cast("string"), F.lit("background")).alias("truth"), F.coalesce(F.col(guess).cast("string"), F.lit("background")).alias("guess")).groupBy("truth", "guess").agg(F.count("*").alias("n"))


def mean_iou(counts: DataFrame) -> DataFrame:
    """(mean_iou, weighted_iou) of a confusion table (truth, guess, n), with 1 added to each union."""
    t = counts.groupBy(F.col("truth").alias("c")).agg(F.sum("n").alias("t"))
    g = counts.groupBy(F.col("guess").alias("c")).agg(F.sum("n").alias("g"))
    i = counts.filter("truth = guess").select(F.col("truth").alias("c"), F.col("n").alias("i"))
    j = t.join(g, "c", "left").join(i, "c", "left").select("c", "t", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("i", F.lit(0)).alias("i"))
    iou = F.col("i") / (F.col("t") + F.col("g") - F.col("i") + 1)
    return j.agg(F.avg(iou).alias("mean_iou"), (F.sum(iou * F.col("t")) / F.sum("t")).alias("weighted_iou"))


def top_k_accuracy(df: DataFrame, truth: str, ranked: str, k: int = 5) -> DataFrame:
    """(top1, topk) of rows whose `ranked` array lists guesses, best first."""
    return df.agg(F.avg((F.get(ranked, F.lit(0)) == F.col(truth)).cast("double")).alias("top1"), F.avg(F.array_contains(F.slice(ranked, 1, k), F.col(truth)).cast("double")).alias("topk"))


def recall_possible(boxes: DataFrame, anchors: list[tuple[float, float]], threshold: float = 4.0) -> DataFrame:
    """(recall, past): the share of boxes (w, h) some anchor fits within the ratio, and how many anchors do on average."""
    fits = F.array(*[F.greatest(F.col("w") / a, F.lit(a) / F.col("w"), F.col("h") / b, F.lit(b) / F.col("h")) < threshold for a, b in anchors])
    n = F.size(F.filter(fits, lambda x: x))
    return boxes.agg(F.avg((n > 0).cast("double")).alias("recall"), F.avg(n.cast("double")).alias("past"))


def mean_height_grid(boxes: DataFrame, width: float, height: float, nx: int, ny: int) -> DataFrame:
    """(i, j, n, height): the mean height of the boxes whose first corner lies in a cell of the grid."""
    cell = boxes.select(bin_index(F.col("x1"), 0.0, width, nx).alias("i"), bin_index(F.col("y1"), 0.0, height, ny).alias("j"), (F.col("y2") - F.col("y1")).alias("h"))
    return cell.groupBy("i", "j").agg(F.count("*").alias("n"), F.avg("h").alias("height"))


def player_statistics(points: DataFrame, team: str, number: str, track: str = "entity", share: float = 0.5, stride: int = 5, fps: float = 29.97, unit: float = 0.1, least: int = 4) -> DataFrame:
    """Statistics of players over all their tracks. First each track: distance, mean, greatest and tenth-percentile speed, and the
    second part's over the first part's; then by (team, number): sum, mean, greatest, least, and the means of the four ratios."""
    s = tall.sampled_speed(points, [team, number, track], "frame", "rn", stride, fps, unit)
    w = Window.partitionBy(team, number, track)
    s = s.withColumn("_n", F.count("*").over(w)).withColumn("_i", F.row_number().over(w.orderBy("rn")))
    first = F.col("_i") <= F.floor(F.col("_n") * share)
    low = lambda c: F.percentile(c, 0.1)
    kinds = {"distance": (F.sum, "metres"), "avg_speed": (F.avg, "kmh"), "max_speed": (F.max, "kmh"), "min_speed": (low, "kmh")}
    each = []
    for name, (f, c) in kinds.items():
        each += [f(c).alias(name), f(F.when(first, F.col(c))).alias(f"{name}_1"), f(F.when(~first, F.col(c))).alias(f"{name}_2")]
    t = s.groupBy(team, number, track).agg(F.count("*").alias("n"), *each)
    ratio = lambda c: F.when((F.col("n") >= least) & (F.col(f"{c}_1") > 0), F.col(f"{c}_2") / F.col(f"{c}_1"))
    t = t.select(team, number, *kinds, *[ratio(c).alias(f"{c}_ratio") for c in kinds])
    out = {"distance": F.sum, "avg_speed": F.avg, "max_speed": F.max, "min_speed": F.min}
    return t.groupBy(team, number).agg(*[f(c).alias(c) for c, f in out.items()], *[F.avg(f"{c}_ratio").alias(f"{c}_ratio") for c in kinds])


def keeper_track(tracks: DataFrame, by: list[str], track: str, score: str) -> DataFrame:
    """(by, track, total): the track with the largest sum of scores that aren't null, -1 or less doesn't count; ties to the smaller id."""
    sums = tracks.groupBy(*by, track).agg(F.coalesce(F.sum(score), F.lit(0.0)).alias("total")).filter("total > -1")
    w = Window.partitionBy(*by).orderBy(F.desc("total"), track)
    return sums.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def ball_track(tracks: DataFrame, by: list[str], track: str, n: str) -> DataFrame:
    """The track that is the ball: that of id -1, else the longest (the only one if there is no other); ties to the smaller id."""
    w = Window.partitionBy(*by).orderBy((F.col(track) != -1).cast("int"), F.desc(n), track)
    return tracks.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def first_teams(rows: DataFrame, by: list[str], order: str, team: str, most: int = 2) -> DataFrame:
    """(by, teams): the first `most` distinct labels in order; sorted if there are `most`, else as they come."""
    first = rows.groupBy(*by, team).agg(F.min(order).alias("o"))
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("o", team))).filter(F.col("_r") <= most)
    return first.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", team))), lambda s: s[team]).alias("t")).select(*by, F.when(F.size("t") == most, F.array_sort("t")).otherwise(F.col("t")).alias("teams"))


def histogram(pixels: DataFrame, by: list[str], channels: list[tuple[str, float, int]]) -> DataFrame:
    """(by, bin, share): the share of each occupied bin of a joint histogram over channels (column, top, bins); bins count on, the
    last channel fastest. Pixels with a null channel don't count."""
    bin_ = F.lit(0).cast("long")
    for c, top, n in channels:
        bin_ = bin_ * n + bin_index(F.col(c), 0.0, top, n)
    seen = pixels.filter(" AND ".join(f"{c} IS NOT NULL" for c, *_ in channels))
    g = seen.groupBy(*by, bin_.alias("bin")).agg(F.count("*").alias("n"))
    return g.select(*by, "bin", (F.col("n") / F.sum("n").over(Window.partitionBy(*by))).alias("share"))


def profile(rows: DataFrame, stage: str, seconds: str, items: str) -> DataFrame:
    """(stage, seconds, items, each): the time of each stage and that of an item in it, 0 without items."""
    g = rows.groupBy(stage).agg(F.sum(seconds).alias("seconds"), F.sum(items).alias("items"))
    return g.withColumn("each", F.when(F.col("items") > 0, F.col("seconds") / F.col("items")).otherwise(0.0))


def extents(points: DataFrame, by: list[str], order: str) -> DataFrame:
    """(by, n, length, width, height, median_step): of each track how far it goes, what room it takes and its median step."""
    w = Window.partitionBy(*by).orderBy(order)
    d = distance(F.col("x"), F.col("y"), F.lag("x").over(w), F.lag("y").over(w))
    g = points.withColumn("_d", d).groupBy(*by)
    return g.agg(F.count("*").alias("n"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("length"), (F.max("x") - F.min("x")).alias("width"), (F.max("y") - F.min("y")).alias("height"), F.percentile("_d", 0.5).alias("median_step"))


def epoch_totals(steps: DataFrame, correct: str, ned: str, loss: str, n: str) -> DataFrame:
    """(samples, accuracy, ned, loss): batches weighted by their number of samples."""
    weighted = lambda c: F.sum(F.col(c) * F.col(n)) / F.sum(n)
    return steps.agg(F.sum(n).alias("samples"), (F.sum(correct) / F.sum(n)).alias("accuracy"), (1 - F.sum(ned) / F.sum(n)).alias("ned"), weighted(loss).alias("loss"))


def box_smooth(df: DataFrame, by: list[str], order: str, value: str, share: float = 0.05, out: str = "smoothed") -> DataFrame:
    """A running mean over round(n * share * 2) // 2 + 1 rows, for which the ends of a curve stand for what lies beyond them."""
    whole = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumns({"_bs_n": F.count("*").over(whole), "_bs_a": F.first(value).over(whole), "_bs_z": F.last(value).over(whole), "_bs_i": F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1})
    half = F.floor((F.floor(F.rint(F.col("_bs_n") * share * 2) / 2) + 1) / 2)
    # the window's length follows each curve's, so sums come from running totals
    total = F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_bs_t", total).withColumn("_bs_s", F.collect_list("_bs_t").over(whole)).withColumn("_bs_h", half.cast("int"))
    low, high = F.greatest(F.col("_bs_i") - F.col("_bs_h"), F.lit(0)), F.least(F.col("_bs_i") + F.col("_bs_h"), F.col("_bs_n") - 1).cast("int")
    inner = F.get("_bs_s", high) - F.when(low > 0, F.get("_bs_s", (low - 1).cast("int"))).otherwise(0.0)
    pad = F.greatest(F.col("_bs_h") - F.col("_bs_i"), F.lit(0)) * F.col("_bs_a") + F.greatest(F.col("_bs_i") + F.col("_bs_h") - F.col("_bs_n") + 1, F.lit(0)) * F.col("_bs_z")
    return df.withColumn(out, (inner + pad) / (2 * F.col("_bs_h") + 1)).drop("_bs_n", "_bs_a", "_bs_z", "_bs_i", "_bs_t", "_bs_s", "_bs_h")


def end_means(df: DataFrame, by: list[str], order: str, value: str, first: int = 5, last: int = 10) -> DataFrame:
    """(by, n, first_mean, last_mean, decreases): means of an entity's first and last values, and whether any of its last ones is
    smaller than the one before."""
    g = df.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("double").alias("v")))), lambda s: s["v"]).alias("v"))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    tail = F.slice("v", -F.least(F.size("v"), F.lit(last)), F.lit(last))
    g = g.withColumn("t", tail)
    falls = F.exists(F.sequence(F.lit(1), F.size("t")), lambda i: (i < F.size("t")) & (F.get("t", i) < F.get("t", i - 1)))
    return g.select(*by, F.size("v").cast("long").alias("n"), mean(F.slice("v", 1, first)).alias("first_mean"), mean(F.col("t")).alias("last_mean"), F.coalesce(falls, F.lit(False)).alias("decreases"))


def aspect_batches(images: DataFrame, image: str, ratio: str, batch: int) -> DataFrame:
    """Images by aspect ratio in batches: columns batch and shape (1 where it spans both kinds, else its widest or highest ratio)."""
    b = numbered(images, [], [ratio, image], "_p").withColumn("batch", F.expr(f"_p div {batch}")).drop("_p")
    s = b.groupBy("batch").agg(F.min(ratio).alias("low"), F.max(ratio).alias("high"))
    s = s.select("batch", F.when(F.col("high") < 1, F.col("high")).when(F.col("low") > 1, 1 / F.col("low")).otherwise(1.0).alias("shape"))
    return b.join(s, "batch")


def fittest(rows: DataFrame, fitness: Column, n: int = 5, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(the n fittest rows, one of them as parent): the parent is drawn by weight, fitness less the least of them, by a hash of the
    seed and the row's id, so reruns agree."""
    top = rows.withColumn("fitness", fitness).orderBy(F.desc("fitness"), "id").limit(n)
    weight = F.col("fitness") - F.min("fitness").over(Window.partitionBy(F.lit(1))) + 1e-6
    # the exponential race: the smallest -log(u) / weight wins with a chance in proportion to its weight
    u = (F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) + 1) / float(1 << 53)
    parent = top.withColumn("_k", -F.log(u) / weight).orderBy("_k", "id").limit(1).drop("_k")
    return top, parent


def evolution(rows: DataFrame, order: str, fitness: Column) -> DataFrame:
    """Adds `fitness` and `best`, the greatest so far; the row where they are equal last is the best of all."""
    placed = numbered(rows.withColumn("fitness", fitness), [], [order], "_p")
    return tall.running(placed, [], "_p", "fitness", "best", greatest=True).drop("_p")
