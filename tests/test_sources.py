from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pathloom.operators import keeper, tracks
from pathloom.sources import files
from pathloom.streaming import tracks as streaming


def test_radar(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a\nb\nc\nDate,Time,Session Title,Count,Speed,Unit\n2025-02-08,17:39:05,x,1,26,MPH\n2025-02-08,17:39:06,x,2,20,KPH\n")
    got = files.read_radar(spark, str(tmp_path / "r.csv")).orderBy("at").collect()
    assert got[0]["at"] == datetime(2025, 2, 8, 9, 39, 5) and abs(got[0].kmh - 41.84284) < 1e-9 and got[1].kmh == 20


def test_shards(spark, tmp_path):
    d = spark.range(12_000).select(F.lit("v").alias("file_key"), F.col("id").alias("frame_local"), F.lit(0.5).alias("conf"))
    files.write_shards(d, str(tmp_path / "s"))
    assert sorted(r.frame_local for r in files.read_range(spark, str(tmp_path / "s"), "v", 4998, 5003).collect()) == [4998, 4999, 5000, 5001, 5002]


def test_lines_and_labels(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"frame_id": 1, "projected": [1.0, 2.0]}\n\nnot json\n')
    assert files.read_lines(spark, str(tmp_path / "t.jsonl"), files.RAW_BALL, True).filter("frame_id = 1").count() == 1
    (tmp_path / "l.txt").write_text("0 .5 .5 .1 .1\n0 .5 .5 .1 .1\n1 2 .5 .1 .1\n")
    assert sorted(r.valid for r in files.read_labels(spark, str(tmp_path / "l.txt")).collect()) == [False, True]


def test_stream_equals_batch(spark, tmp_path):
    base = datetime(2024, 1, 1)
    rows = [(i, k, base + timedelta(minutes=17 * i * (1 + k))) for k in range(3) for i in range(20)]
    rows.append((99, 0, base + timedelta(days=9)))
    df = spark.createDataFrame(rows, "id long, user long, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    batch = {tuple(r) for r in streaming.sessions(df, "user", gap="30 minutes").collect() if r.end < base + timedelta(days=8)}
    live = streaming.drain(streaming.sessions(streaming.stream(spark, str(tmp_path / "in"), df.schema), "user", gap="30 minutes"), "live_sessions", str(tmp_path / "cp"))
    assert {tuple(r) for r in live.collect()} == batch


def test_split_and_stitch(spark):
    t = spark.createDataFrame([(1, i, "h" if i < 10 else "a") for i in range(20)], "e long, f long, t string")
    got = {(r.piece, r.n) for r in tracks.split_by_label(t, ["e"], "f", "t", 5, 0.9).groupBy("piece").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 10), ("b", 10)}
    p = spark.createDataFrame([("h", 1, 0, 10, 0.0, 0.0, 5.0, 5.0), ("h", 2, 15, 30, 6.0, 6.0, 9.0, 9.0), ("h", 3, 16, 40, 300.0, 300.0, 1.0, 1.0)], "team string, piece long, start long, end long, x0 double, y0 double, x1 double, y1 double")
    assert {r.piece: r.track for r in tracks.stitch(p, ["team"]).collect()} == {1: 1, 2: 1, 3: 3}
    b = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.3), (0, 1, 100.0, 0.0, 0.9), (0, 2, 5.0, 0.0, 0.9), (0, 2, 98.0, 0.0, 0.5)], "k long, f long, x double, y double, conf double")
    assert [r.x for r in tracks.fuse_ball(b, ["k"], "f").orderBy("f").collect()] == [100.0, 98.0]


def test_keeper():
    assert keeper.tags([None], [None], None) == [0]
    skel = [[float(i), float(i)] for i in range(17)]
    assert 8 in keeper.tags([skel], [[500, 500, 510, 510]], 10.0)
