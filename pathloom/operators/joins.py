"""Joins of tracking data, all with an equality key so that none is a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered


def band(left: DataFrame, right: DataFrame, on: list[str], at: str, other: str, below: int, above: int) -> DataFrame:
    """Pairs with other in [at - below, at + above]: rows meet in buckets of that width, then by the exact test."""
    width = max(1, below + above)
    a = left.withColumn("_b", F.explode(F.sequence(F.floor((F.col(at) - below) / width), F.floor((F.col(at) + above) / width))))
    b = right.withColumn("_b", F.floor(F.col(other) / width))
    return a.join(b, [*on, "_b"]).filter(F.col(other).between(F.col(at) - below, F.col(at) + above)).drop("_b")


def overlap(left: DataFrame, right: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], bucket: int) -> DataFrame:
    """Pairs of intervals (ends inclusive) that overlap, with start `lo` and end `hi` of what they share. A pair is kept in the
    first bucket that both touch, so it comes once."""
    spread = lambda df, s, e: df.withColumn("_k", F.explode(F.sequence(F.floor(F.col(s) / bucket), F.floor(F.col(e) / bucket))))
    both = spread(left, *a).join(spread(right, *b), [*on, "_k"])
    both = both.withColumn("lo", F.greatest(a[0], b[0])).withColumn("hi", F.least(a[1], b[1]))
    return both.filter((F.col("lo") <= F.col("hi")) & (F.floor(F.col("lo") / bucket) == F.col("_k"))).drop("_k")


def as_of(left: DataFrame, right: DataFrame, on: list[str], at: str, other: str, values: list[str]) -> DataFrame:
    """Adds to each row of `left` the values of the latest row of `right` at or before it, by one union and a window."""
    a = left.select("*", F.lit(1).alias("_side"), F.col(at).alias("_at"), *[F.lit(None).cast(right.schema[v].dataType).alias(f"_v_{v}") for v in values])
    b = right.select(*on, F.lit(0).alias("_side"), F.col(other).alias("_at"), *[F.col(v).alias(f"_v_{v}") for v in values])
    w = Window.partitionBy(*on).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True)
    for v in values:
        both = both.withColumn(v, F.last(f"_v_{v}", True).over(w))
    return both.filter("_side = 1").select(*[F.col(c) for c in left.columns if c not in values], *values)


def best_pairs(pairs: DataFrame, by: list[str], left: str, right: str, score: str, second_by: str = "score") -> DataFrame:
    """One-to-one pairs in two passes: the best right for every left, then one left for every right: that of the best score, or,
    with second_by="left", that of the smallest left number."""
    one = pairs.withColumn("_r", F.row_number().over(Window.partitionBy(*by, left).orderBy(F.desc(score), right))).filter("_r = 1")
    order = [F.desc(score), F.col(left)] if second_by == "score" else [F.col(left)]
    return one.withColumn("_r", F.row_number().over(Window.partitionBy(*by, right).orderBy(*order))).filter("_r = 1").drop("_r")


def greedy_pairs(pairs: DataFrame, by: list[str], left: str, right: str, score: str) -> DataFrame:
    """One-to-one pairs taken by descending score, whichever ends are still free; in rounds of mutually best pairs, folded in each group.
    The fold keeps the used ends of one frame only."""
    item = F.struct((-F.col(score)).alias("s"), F.col(left).cast("long").alias("l"), F.col(right).cast("long").alias("r"))
    start = F.array().cast("array<struct<s:double,l:bigint,r:bigint>>")
    step = lambda done, x: F.when(F.exists(done, lambda d: (d["l"] == x["l"]) | (d["r"] == x["r"])), done).otherwise(F.concat(done, F.array(x)))
    out = pairs.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("_p")).select(*by, F.inline(F.aggregate("_p", start, step)))
    return out.select(*by, F.col("l").alias(left), F.col("r").alias(right), (-F.col("s")).alias(score))


def window_parts(windows: DataFrame, chapters: DataFrame, on: list[str], bucket: int = 10_000) -> DataFrame:
    """Windows [start, end) cut at the chapters (on, chapter, g_start, g_end; ends exclusive) that they touch: the part of each chapter in
    its own frames, columns local_start and local_end."""
    w = windows.withColumn("_e", F.col("end") - 1)
    c = chapters.withColumn("_g", F.col("g_end") - 1)
    both = overlap(w, c, on, ("start", "_e"), ("g_start", "_g"), bucket)
    return both.withColumn("local_start", F.col("lo") - F.col("g_start")).withColumn("local_end", F.col("hi") + 1 - F.col("g_start")).drop("_e", "_g", "lo", "hi")


def to_global(rows: DataFrame, chapters: DataFrame, on: list[str], frame: str, name: str = "global_frame") -> DataFrame:
    """Frames of chapters as frames of the whole recording; `chapters`: (on, g_start)."""
    return rows.join(chapters.select(*on, "g_start"), on).withColumn(name, F.col(frame) + F.col("g_start")).drop("g_start")


def by_position(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows put together by their numbers in either order; a ValueError if the counts differ."""
    if left.count() != right.count():
        raise ValueError("both sides need the same number of rows")
    return numbered(left, [], [left_order], "_p").join(numbered(right, [], [right_order], "_p"), "_p").drop("_p")


def unmatched(detections: DataFrame, tracks: DataFrame, on: list[str], detection: str, iou: Column, most: float = 0.5) -> DataFrame:
    """Detections that overlap no track of their frame by more than `most`; `iou` reads the columns of both sides."""
    hit = detections.join(tracks, on).filter(iou > most).select(*on, detection).distinct()
    return detections.join(hit, [*on, detection], "left_anti")


def sidecars(videos: DataFrame, files: DataFrame, video: str, name: str, token: str, changed: str) -> DataFrame:
    """(video, name): for each video the file whose name begins with the video's and holds the token; of several the shortest name,
    then the newest, then the smaller name. A file meets whole video names: its own openings of the lengths that video names have."""
    v = videos.select(F.col(video).alias("_v")).distinct()
    lengths = v.agg(F.array_sort(F.collect_set(F.length("_v"))).alias("_n"))  # one row, of as many numbers as there are lengths of names
    b = files.filter(F.col(name).contains(token)).crossJoin(F.broadcast(lengths))
    b = b.select(name, changed, F.explode(F.filter("_n", lambda n: n <= F.length(name))).alias("_n")).withColumn("_v", F.substring(F.col(name), F.lit(1), F.col("_n")))
    w = Window.partitionBy("_v").orderBy(F.length(name), F.desc(changed), name)
    both = v.join(b, "_v").withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return both.select(F.col("_v").alias(video), name)


def label_path(image: Column) -> Column:
    """The label file of an image: the last folder named images becomes labels, the ending txt."""
    return F.concat(F.regexp_replace(F.regexp_replace(image, r"\.[^./]*$", ""), r"/images/(?!.*/images/)", "/labels/"), F.lit(".txt"))
