from pathloom.operators import roster

TRACKS = "team string, track long, number int, conf double, start long, end long"


def test_resolve_numbers(spark):
    t = spark.createDataFrame([("h", 1, 7, 0.9, 0, 100), ("h", 2, 7, 0.5, 50, 150), ("h", 3, 17, 0.9, 60, 70), ("h", 4, 7, 0.4, 500, 600), ("h", 5, 99, 0.9, 0, 9)], TRACKS)
    r = spark.createDataFrame([("h", [7, 17, 27])], "team string, numbers array<int>")
    got = {x.track: (x.number, x.state) for x in roster.resolve_numbers(t, r, 64).collect()}
    assert got == {1: (7, "kept"), 2: (27, "changed"), 3: (17, "kept"), 4: (7, "kept"), 5: (99, "kept")}
    assert {x.track: x.number for x in roster.valid_numbers(t, r).collect()}[5] is None


def test_relabel(spark):
    t = spark.createDataFrame([("h", i, i, 0.001 * i, 0, 100) for i in range(1, 13)], TRACKS)
    w = spark.createDataFrame([("h", 12, 10, 60)], "team string, n long, w_start long, w_end long")
    got = roster.relabel_excess(t, w, 10, bucket=64).filter("relabelled").collect()
    assert sorted(x.track for x in got) == [1, 2] and all(x.team == "unsure" for x in got)
