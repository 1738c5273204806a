"""Sources and sinks: two-schema reading, tracks, balls, histograms, labels, exports."""

import json

import numpy as np

from pathloom.sources import files, labelfiles


def test_two_schemas(spark, tmp_path):
    lines = [{"track_id": 7, "team": "home", "frame_id": [1, 2], "projected": [[1.0, 2.0], [3.0, 4.0]]}, {"track_id": 8, "frames": [5], "points": [[9.0, 8.0]]}, {"id": 3, "frame": 4, "x": 5.0, "y": 6.0}, {"id": 4, "frame_id": 9, "projected": [0.5, 0.25]}]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n")
    got = sorted((r.track_id, r.frame, r.team, r.x, r.y) for r in files.read_tracks(spark, str(tmp_path / "t.jsonl")).collect())
    assert got == [("3", 4, None, 5.0, 6.0), ("4", 9, None, 0.5, 0.25), ("7", 1, "home", 1.0, 2.0), ("7", 2, "home", 3.0, 4.0), ("8", 5, None, 9.0, 8.0)]


def test_track_and_ball_sinks(spark, tmp_path):
    rows = [(1, f, float(f), 0.0, 0.9) for f in (3, 1, 2, 500)] + [(2, 9, 1.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "track_id long, frame long, x double, y double, conf double")
    files.write_tracks(df, str(tmp_path / "a"))
    files.write_tracks(df, str(tmp_path / "b"), idle=50)
    read = lambda p: sorted((r.track_id, r.frame_id) for r in spark.read.schema("track_id long, frame_id array<long>").json(str(tmp_path / p)).collect())
    assert read("a") == [(1, [1, 2, 3, 500]), (2, [9])] and read("b") == [(1, [1, 2, 3]), (1, [500]), (2, [9])]
    back = files.read_tracks(spark, str(tmp_path / "a"))
    assert sorted((int(r.track_id), r.frame, r.x) for r in back.collect()) == sorted((t, f, x) for t, f, x, *_ in rows)
    ball = spark.createDataFrame([(4, 1.0, 2.0, 3.0, 4.0, 0.5, 9.0, 8.0)], "frame long, x1 double, y1 double, x2 double, y2 double, conf double, x double, y double")
    files.write_ball(ball, str(tmp_path / "ball"))
    assert [tuple(r) for r in files.read_lines(spark, str(tmp_path / "ball"), files.RAW_BALL).collect()] == [(4, [1.0, 2.0, 3.0, 4.0, 0.5], [9.0, 8.0])]
    line = files.ball_line(ball.select("frame", "x", "y"))
    assert [tuple(r) for r in files.ball_matrix(line).collect()] == [(4, 9.0, 8.0)]


def test_arrays_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"frame_id": i, "bbox": [1.0]} for i in range(5)]))
    files.array_to_lines(spark, str(tmp_path / "a.json"), str(tmp_path / "l"), files.RAW_BALL)
    files.lines_to_array(spark, str(tmp_path / "l"), str(tmp_path / "back"), files.RAW_BALL)
    parts = [json.loads(p.read_text()) for p in (tmp_path / "back").glob("part-*.txt")]
    assert sorted(r["frame_id"] for part in parts for r in part) == list(range(5))
    assert sorted(r.frame_id for r in files.read_array(spark, str(tmp_path / "back"), files.RAW_BALL).collect()) == list(range(5))


def test_recursive_without_derived(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "y" / "raw.jsonl").write_text('{"frame_id": 1}\n')
    (tmp_path / "x" / "raw_tracks.jsonl").write_text('{"frame_id": 2}\n')
    got = files.read_lines(spark, str(tmp_path / "x"), files.RAW_BALL, recursive=True, but=r"_tracks\.jsonl$")
    assert [r.frame_id for r in got.collect()] == [1]


def test_histograms(spark, tmp_path):
    np.save(tmp_path / "home_01.npy", np.array([[1.0, 3.0]]))
    np.save(tmp_path / "away.npy", np.array([2, 2]))
    got = {r.name: (r.team, r.histogram) for r in files.read_histograms(spark, str(tmp_path)).collect()}
    assert got == {"home_01.npy": ("home", [0.25, 0.75]), "away.npy": ("away", [0.5, 0.5])}


def test_label_outcomes(spark, tmp_path):
    for name, text in (("a.txt", "0 .5 .5 .1 .1\n0 .5 .5 .1 .1\n"), ("b.txt", ""), ("c.txt", "0 5 .5 .1 .1\n")):
        (tmp_path / name).write_text(text)
    images = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",), ("d.txt",)], "file string")
    r = files.label_outcomes(spark, str(tmp_path), images).first()
    assert (r.missing, r.found, r.empty, r.corrupt, r.duplicates) == (1, 1, 1, 1, 1)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 0.5, 0.25, 0.1, 0.2, 0.9, [[1.0, 2.0], [3.0, 4.0]]), (1, 2, 0.5, 0.5, 0.1, 0.2, 0.8, [[0.0, 0.0]])], "image long, cls int, cx double, cy double, w double, h double, conf double, k array<array<double>>")
    files.write_yolo_lines(df, str(tmp_path / "y"), conf=False, keypoints="k")
    assert spark.read.parquet(str(tmp_path / "y")).first().labels.split("\n")[0] == "0 0.500000 0.250000 0.100000 0.200000 1.000000 2.000000 3.000000 4.000000"
    labelfiles.write_label_files(df, str(tmp_path / "z"))
    assert spark.read.text(str(tmp_path / "z" / "part-*")).count() == 2
    files.write_csv(df.drop("k"), str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).columns == df.drop("k").columns
    files.write_by_clip(df.withColumnRenamed("image", "clip_id"), str(tmp_path / "j"))
    assert (tmp_path / "j" / "clip_id=1").is_dir()


def test_blocks_are_pruned(spark, tmp_path):
    rows = [("a", f, 0.5) for f in range(0, 20_000, 500)] + [("b", 1, 0.5)]
    files.write_shards(spark.createDataFrame(rows, "file_key string, frame_local long, conf double"), str(tmp_path / "s"))
    part = files.read_range(spark, str(tmp_path / "s"), "a", 5200, 9800)
    assert sorted(r.frame_local for r in part.collect()) == list(range(5500, 9800, 500))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "block" in plan.split("PartitionFilters: [")[1].split("]")[0]
