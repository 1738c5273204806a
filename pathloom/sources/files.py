"""JSON lines, radar tables, label files, sharded detections and exports."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_PLAYER = "track_id long, frame_id array<long>, team_conf array<map<string,double>>, jersey_num array<int>, jersey_conf string, bbox array<array<double>>, projected array<array<double>>"
RAW_BALL = "frame_id long, bbox array<double>, projected array<double>"
TRACK = "track_id string, team string, jersey_num string, jersey_conf double, frame_range array<long>, frames array<long>, projected array<array<double>>, team_conf double"
DETECTION = "file_key string, frame_local long, cls_idx int, cls_name string, conf double, bbox_xyxy array<double>, bbox_warp array<double>"
CLIP_LOG = "type string, clip_path string, group_key string, window_global array<long>, fps double, video_time_repr double, real_time_repr string, clip_frame long, global_frame long, " + DETECTION
RADAR = "day string, clock string, title string, count int, speed double, unit string, rest string"
BLOCK_FRAMES = 5000


def read_lines(spark: SparkSession, path: str, schema: str, drop_malformed: bool = False, recursive: bool = False, but: str | None = None) -> DataFrame:
    """JSON lines; blank lines don't count, malformed ones fail or are dropped. With `recursive` all folders below are read, `but` is a pattern
    of file names to leave out, such as those of derived files."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED" if drop_malformed else "FAILFAST")
    out = reader.option("recursiveFileLookup", str(recursive).lower()).json(path)
    return out.filter(~F.col("_metadata.file_name").rlike(but)) if but else out


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def array_to_lines(spark: SparkSession, source: str, target: str, schema: str) -> None:
    """A JSON array rewritten as JSON lines."""
    read_array(spark, source, schema).write.mode("overwrite").json(target)


def lines_to_array(spark: SparkSession, source: str, target: str, schema: str) -> None:
    """JSON lines rewritten as JSON arrays, one for each part file, so that no task holds more than its part."""
    rows = read_lines(spark, source, schema).select(F.to_json(F.struct("*")).alias("value"))

    def bracketed(batches):
        first = True
        for batch in batches:
            lines = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"value": [("[" if first and not i else ",") + x for i, x in enumerate(lines)]})
            first = first and not lines
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    rows.mapInArrow(bracketed, "value string").write.mode("overwrite").text(target)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """(track_id, frame, team, x, y) of lines in either of two forms: a track with arrays (frame_id or frames, projected or points), or one
    detection (frame or frame_id as a number, x and y or projected)."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json("value", F.lit("track_id string, id string, team string, frame_id string, frames string, frame string, projected string, points string, x double, y double")).alias("r")).select("r.*")
    frames, places = F.coalesce("frames", "frame_id"), F.coalesce("projected", "points")
    many = F.coalesce(frames.startswith("["), F.lit(False))
    name = F.coalesce("track_id", "id").alias("track_id")
    zipped = F.arrays_zip(F.from_json(frames, F.lit("array<bigint>")).alias("f"), F.from_json(places, F.lit("array<array<double>>")).alias("p"))
    a = lines.filter(many).select(name, "team", F.explode(zipped).alias("z")).select("track_id", F.col("z.f").alias("frame"), "team", F.get("z.p", F.lit(0)).alias("x"), F.get("z.p", F.lit(1)).alias("y"))
    place = F.from_json(places, F.lit("array<double>"))
    b = lines.filter(~many).select(name, F.coalesce("frame", frames).cast("long").alias("frame"), "team", F.coalesce("x", F.get(place, F.lit(0))).alias("x"), F.coalesce("y", F.get(place, F.lit(1))).alias("y"))
    return a.unionByName(b, allowMissingColumns=True)


def read_histograms(spark: SparkSession, folder: str, prefix: str = r"^(.*?)(?:_\d+)?\.np[yz]$") -> DataFrame:
    """(team, name, histogram) of the .npy and .npz files in a folder: team is the name's beginning, values add up to 1. Of an archive's arrays
    the one named hist counts, else the first by name; one without arrays has no histogram. Nothing is unpickled; a file that isn't made of plain
    arrays of numbers raises."""

    @F.pandas_udf("array<double>")
    def decode(content: pd.Series) -> pd.Series:
        def one(data: bytes):
            h = np.load(io.BytesIO(data), allow_pickle=False)
            if isinstance(h, np.lib.npyio.NpzFile):
                if not h.files:
                    return None
                h = h["hist" if "hist" in h.files else min(h.files)]
            h = h.astype(float).ravel()
            return (h / h.sum() if h.sum() > 0 else h).tolist()

        return content.map(one)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.np[yz]").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.regexp_extract(name, prefix, 1).alias("team"), name.alias("name"), decode("content").alias("histogram"))


def read_tagged(spark: SparkSession, path: str, schema: str = CLIP_LOG) -> tuple[DataFrame, DataFrame]:
    """(meta rows, other rows) of a log whose lines carry a type."""
    rows = read_lines(spark, path, schema)
    return rows.filter("type = 'meta'"), rows.filter("type <> 'meta' OR type IS NULL")


def read_radar(spark: SparkSession, path: str, offset: str = "+08:00") -> DataFrame:
    """Readings of a radar table, found as the lines that begin with a date; columns at (timestamp) and kmh."""
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\d{1,4}[-/]\d{1,2}[-/]\d{1,4}\s*,"))
    row = F.from_csv("value", F.lit("day string, clock string, title string, count string, speed string, unit string"), {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true"})
    r = lines.select(row.alias("r")).select("r.*")
    text = F.concat_ws(" ", F.trim("day"), F.trim("clock"))
    at = F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm:ss a")])
    speed = F.col("speed").try_cast("double")
    return r.select(F.to_utc_timestamp(at, offset).alias("at"), F.when(F.upper(F.trim("unit")) == "MPH", speed * 1.60934).otherwise(speed).alias("kmh"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label files `class x y w h`: (file, cls, box, valid), equal rows of a file once."""
    t = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.split(F.trim("value"), r"\s+").alias("p")).filter(F.size("p") > 1)
    box = F.transform(F.slice("p", 2, 4), lambda v: v.try_cast("double"))
    rows = t.select("file", F.element_at("p", 1).try_cast("int").alias("cls"), box.alias("box"), (F.size("p") == 5).alias("five"))
    return rows.select("file", "cls", "box", (F.col("five") & F.forall("box", lambda v: v.isNotNull() & (v >= 0) & (v <= 1)) & (F.col("cls") >= 0)).alias("valid")).dropDuplicates()


def label_outcomes(spark: SparkSession, path: str, images: DataFrame) -> DataFrame:
    """(missing, found, empty, corrupt, duplicates): what became of the label files of `images` (file: the name of its label file). A
    corrupt file holds a row that isn't valid; duplicates are rows that a file repeats."""
    content = F.decode("content", "UTF-8")
    t = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.filter(F.split(F.trim(content), r"\s*\n\s*"), lambda x: x != "").alias("rows"))
    # scans pass over files of no bytes, so the folder's listing tells of them
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    blank = [(f.getPath().getName(), []) for f in listed if f.isFile() and f.getLen() == 0]
    t = t.unionByName(spark.createDataFrame(blank, t.schema))
    labels = read_labels(spark, path)
    bad = labels.filter(~F.coalesce("valid", F.lit(False))).select("file").distinct().withColumn("bad", F.lit(True))
    j = images.select("file").distinct().join(t, "file", "left").join(bad, "file", "left")
    n = F.size("rows")
    return j.agg(
        F.count_if(F.col("rows").isNull()).alias("missing"), F.count_if(F.col("rows").isNotNull() & (n > 0) & F.col("bad").isNull()).alias("found"), F.count_if(n == 0).alias("empty"),
        F.count_if(F.col("bad")).alias("corrupt"), F.coalesce(F.sum(n - F.size(F.array_distinct("rows"))), F.lit(0)).alias("duplicates"),
    )


def write_tracks(rows: DataFrame, path: str, idle: int | None = None) -> None:
    """Rows (track_id, frame, x, y, conf) as one JSON line a track, arrays in order of frames; with `idle` a track that isn't seen for so many
    frames ends, and what comes later is a line of its own."""
    from ..operators import tall

    by = ["track_id"]
    if idle is not None:
        rows, by = tall.islands(rows, by, "frame", idle, "part"), [*by, "part"]
    item = F.struct(F.col("frame").alias("f"), F.array("x", "y").alias("p"), F.col("conf").alias("c"))
    g = rows.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("i"))
    part = lambda k: F.transform("i", lambda s: s[k])
    g.select("track_id", part("f").alias("frame_id"), part("p").alias("projected"), part("c").alias("conf")).write.mode("overwrite").json(path)


def write_ball(rows: DataFrame, path: str) -> None:
    """Rows (frame, x1, y1, x2, y2, conf, x, y) as one JSON line a detection of the ball."""
    rows.select(F.col("frame").alias("frame_id"), F.array("x1", "y1", "x2", "y2", "conf").alias("bbox"), F.array("x", "y").alias("projected")).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A table with a header line in each part."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_by_clip(df: DataFrame, path: str, clip: str = "clip_id") -> None:
    """JSON lines of each clip below a folder of its own."""
    df.repartition(clip).write.partitionBy(clip).mode("overwrite").json(path)


def ball_matrix(tracks: DataFrame) -> DataFrame:
    """(frame, x, y) in order of frames from lines of frames and places; frames of 0 or null don't count."""
    z = F.explode(F.arrays_zip(F.col("frames").alias("f"), F.col("projected").alias("p")))
    rows = tracks.select(z.alias("z")).select(F.col("z.f").alias("frame"), F.get("z.p", F.lit(0)).alias("x"), F.get("z.p", F.lit(1)).alias("y"))
    return rows.filter("frame <> 0").orderBy("frame")


def ball_line(matrix: DataFrame) -> DataFrame:
    """The row of D10's form, track 0 of team ball, from (frame, x, y)."""
    g = matrix.agg(F.array_sort(F.collect_list(F.struct("frame", "x", "y"))).alias("i"))
    return g.select(F.lit(0).alias("track_id"), F.lit("ball").alias("team"), F.transform("i", lambda s: s["frame"]).alias("frames"), F.transform("i", lambda s: F.array(s["x"], s["y"])).alias("projected"))


def write_shards(detections: DataFrame, path: str) -> None:
    """Detections below file_key / block of 5000 frames."""
    blocks = detections.withColumn("block", F.floor(F.col("frame_local") / BLOCK_FRAMES))
    blocks.repartition("file_key", "block").write.partitionBy("file_key", "block").mode("append").parquet(path)


def read_range(spark: SparkSession, path: str, file_key: str, start: int, end: int) -> DataFrame:
    """Frames [start, end) of a file; only the blocks that hold them are read."""
    d = spark.read.parquet(path)
    near = F.col("block").between(start // BLOCK_FRAMES, (end - 1) // BLOCK_FRAMES)
    return d.filter((F.col("file_key") == file_key) & near & (F.col("frame_local") >= start) & (F.col("frame_local") < end))


def yolo_line(df: DataFrame, conf: bool = True, keypoints: str | None = None):
    """`class cx cy w h`, then the confidence and flat key points (an array of x, y and sometimes more) if they are asked for."""
    parts = [F.format_string("%d %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "w", "h")]
    if conf:
        parts.append(F.format_string("%.5f", "conf"))
    if keypoints:
        parts.append(F.array_join(F.transform(F.flatten(keypoints), lambda v: F.format_string("%.6f", v)), " "))
    return F.concat_ws(" ", *parts)


def write_yolo_lines(df: DataFrame, path: str, conf: bool = True, keypoints: str | None = None) -> None:
    """(image, labels): all lines of an image in one row of a Parquet table; labelfiles.write_label_files() makes files."""
    lines = df.select("image", yolo_line(df, conf, keypoints).alias("line")).groupBy("image").agg(F.array_sort(F.collect_list("line")).alias("l"))
    lines.select("image", F.array_join("l", "\n").alias("labels")).write.mode("overwrite").parquet(path)


def write_coco(df: DataFrame, path: str) -> None:
    """Result rows of the COCO form: top-left corner and size to 3 places, score to 5."""
    box = F.array(*[F.round(c, 3) for c in (F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))])
    df.select(F.col("image").alias("image_id"), F.col("cls").alias("category_id"), box.alias("bbox"), F.round("conf", 5).alias("score")).write.mode("overwrite").json(path)


def largest_frame(tracks: DataFrame) -> DataFrame:
    return tracks.agg(F.max(F.array_max("frame_id")).alias("last"))
