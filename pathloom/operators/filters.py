"""Row and track filters: times, confidence, classes, edges, sizes, selections. All are projections and windows by entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.boxes import area, over_second
from ..functions.geometry import in_bounds, near_edge
from ..functions.labels import is_ball

# Class numbers of a person and of a ball, and the names they go by.
PERSON, BALL = (0, ("person", "player")), (32, ("sports ball", "ball"))


def game_time(df: DataFrame, frame: str, intervals: list[tuple[int, int]], name: str = "game_frame") -> DataFrame:
    """Rows within any of the intervals (both ends inclusive), frames counted on from 1 over all of them. No row moves."""
    number, before = F.lit(None).cast("long"), 0
    for start, end in intervals:
        number = F.when(F.col(frame).between(start, end), F.col(frame) - start + 1 + before).otherwise(number)
        before += end - start + 1
    return df.withColumn(name, number.cast("long")).filter(F.col(name).isNotNull())


def time_slice(df: DataFrame, frame: str, start: int, end: int) -> DataFrame:
    """Rows between two frames, both included."""
    return df.filter(F.col(frame).between(start, end))


def frame_slice(df: DataFrame, by: list[str], order: str, start: int = 90, end: int = 150, name: str = "number") -> DataFrame:
    """The rows [start, end) of each entity, counted from 0, renumbered from 1."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return df.withColumn(name, n).filter(F.col(name).between(start, end - 1)).withColumn(name, F.col(name) - start + 1)


def confident(df: DataFrame, least: float, classes: list | None = None, conf: str = "conf", cls: str = "cls") -> DataFrame:
    """Rows of at least this confidence, of these classes if any are given."""
    out = df.filter(F.col(conf) >= least)
    return out.filter(F.col(cls).isin(list(classes))) if classes is not None else out


def _class_test(cls: Column, known: tuple) -> Column:
    text = F.lower(F.trim(cls.cast("string")))
    return F.coalesce((text == str(known[0])) | text.isin(*known[1]), F.lit(False))


def is_person_class(cls: Column) -> Column:
    """Whether a class, given by number or name, is a person."""
    return _class_test(cls, PERSON)


def is_ball_class(cls: Column) -> Column:
    """Whether a class, given by number or name, is a ball."""
    return _class_test(cls, BALL)


def is_ball_track(team_scores: Column) -> Column:
    """Whether all entries of a track's team scores (an array of maps) are empty or null."""
    return F.forall(team_scores, lambda m: m.isNull() | (F.size(m) == 0))


def long_tracks(points: DataFrame, by: list[str], least: int = 10, width: float = 1060.0, height: float = 660.0) -> DataFrame:
    """Points in bounds of the tracks that have `least` points before and after that filter."""
    w = Window.partitionBy(*by)
    inside = in_bounds(F.col("x"), F.col("y"), width, height)
    kept = points.withColumn("_a", F.count("*").over(w)).withColumn("_b", F.count_if(inside).over(w))
    return kept.filter((F.col("_a") >= least) & (F.col("_b") >= least) & inside).drop("_a", "_b")


def away_from_edges(points: DataFrame, by: list[str], team: str = "team", margin: float = 30.0, share: float = 0.9, width: float = 1060.0, height: float = 660.0) -> DataFrame:
    """Drops tracks that have `share` of their points within `margin` of an edge; the ball stays."""
    near = F.avg(near_edge(F.col("x"), F.col("y"), margin, width, height).cast("double")).over(Window.partitionBy(*by))
    return points.withColumn("_n", near).filter((F.col("_n") < share) | is_ball(F.col(team).cast("string"))).drop("_n")


def large_boxes(df: DataFrame, least: float = 5000.0, box: tuple = ("x1", "y1", "x2", "y2")) -> DataFrame:
    """Boxes of at least this area."""
    return df.filter(area(tuple(F.col(c) for c in box)) >= least)


def height_drops(df: DataFrame, by: list[str], order: str, height: Column, ratio: float = 0.5) -> DataFrame:
    """Adds `dropped`: the box is lower than `ratio` of the entity's box before."""
    before = F.lag(height).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("dropped", F.coalesce(height < ratio * before, F.lit(False)))


def select_player(tracks: DataFrame, number: int, team: str) -> DataFrame:
    """The tracks of one player: an equal number (text; several candidates don't match) and a team name that holds `team`. No ball."""
    return tracks.filter((F.trim(F.col("jersey_num")) == str(number)) & F.col("team").contains(team) & ~is_ball(F.col("team")))


def in_tile(box: tuple, tile: tuple) -> Column:
    """Whether a box's centre lies in a tile (x1, y1, x2, y2), the lower ends included."""
    cx, cy = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
    return (cx >= tile[0]) & (cx < tile[2]) & (cy >= tile[1]) & (cy < tile[3])


def labelled_images(labels: DataFrame, image: str, cls: str, least: int = 0, include: list | None = None, single: bool = False) -> DataFrame:
    """Labels of the classes to include, of images that have more than `least` of them; all of class 0 if `single`."""
    out = labels.filter(F.col(cls).isin(list(include))) if include is not None else labels
    if least:
        out = out.withColumn("_n", F.count("*").over(Window.partitionBy(image))).filter(F.col("_n") > least).drop("_n")
    return out.withColumn(cls, F.lit(0).cast(labels.schema[cls].dataType)) if single else out


def triggered(box: tuple, side: float = 22.0, both: bool = False) -> Column:
    """Whether a ball's box is `side` or more wide or high (wide and high with `both`)."""
    w, h = box[2] - box[0] >= side, box[3] - box[1] >= side
    return (w & h) if both else (w | h)


def uncovered(boxes: DataFrame, covers: DataFrame, on: list[str], box_id: str, share: float = 0.6) -> DataFrame:
    """Boxes of which no box of `covers` (on, cx1, cy1, cx2, cy2) covers `share` or more."""
    cover = over_second(tuple(F.col(c) for c in ("cx1", "cy1", "cx2", "cy2")), tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")))
    hidden = boxes.join(covers, on).filter(cover >= share).select(*on, box_id).distinct()
    return boxes.join(hidden, [*on, box_id], "left_anti")


def first_detections(df: DataFrame, by: list[str], most: int = 300, order: str = "conf") -> DataFrame:
    """The `most` surest rows of each image with their number."""
    w = Window.partitionBy(*by).orderBy(F.desc(order), "det")
    return df.withColumn("number", F.row_number().over(w)).filter(F.col("number") <= most)


def best_keeps(df: DataFrame, by: list[str], score: str, keep: str, tie: str) -> DataFrame:
    """The row of the greatest score of each frame keeps its `keep`; others get null."""
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score), tie)
    return df.withColumn(keep, F.when(F.row_number().over(w) == 1, F.col(keep)))


def later_than_before(df: DataFrame, by: list[str], arrival: str, frame: str) -> DataFrame:
    """Rows whose frame is greater than that of every row of the entity that arrived before."""
    seen = F.max(frame).over(Window.partitionBy(*by).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_m", seen).filter(F.col("_m").isNull() | (F.col(frame) > F.col("_m"))).drop("_m")
