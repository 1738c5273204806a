"""Queries that take whole texts and all vectors, against brute force."""

import numpy as np

from pathloom.operators import vectors
from pathloom.plans import catalog


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_whole(spark, tmp_path):
    texts = ["a" * 70 + "end", "a" * 70 + "other", "déjà vu " * 12, "deja vu " * 12, "漢字 😀 " * 20, ""]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.item_id: r for r in catalog.queries()["edit_distance_whole"](spark, str(tmp_path)).collect()}
    assert len(got) == 5
    for i, r in got.items():
        want = distance(texts[i], texts[i + 1])
        assert (r.distance, r.similarity) == (want, round(1 - want / max(len(texts[i]), len(texts[i + 1])), 6)) and want > 0


def test_all_vectors_are_candidates(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((90, 8))
    x[40:60] = x[1]  # equal vectors: ties go to the smaller id
    names = [f"l{i % 7}" for i in range(90)]
    names[33] = names[41] = "rare"  # no id of this label is a multiple of 10 or 25
    spark.createDataFrame([(i, v.tolist(), n) for i, (v, n) in enumerate(zip(x, names))], "vec_id long, embedding array<double>, label string").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = np.round(u @ u.T, 12)
    ranked = [[j for j in sorted(range(90), key=lambda j: (-cosine[i, j], j)) if j != i][:5] for i in range(90)]
    df = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    for megabytes, least in ((16, 4), (1, 1), (1, 7)):
        got = {r.id: r for r in vectors.nearest_labels(df, "vec_id", "embedding", "label", 5, megabytes, least).collect()}
        assert [got[i].ranked for i in range(90)] == [[names[j] for j in near] for near in ranked]
    top = catalog.queries()["topk_accuracy_all"](spark, str(tmp_path)).first()
    hits = lambda k: round(np.mean([names[i] in [names[j] for j in near[:k]] for i, near in enumerate(ranked)]), 6)
    assert (top.top1, top.topk) == (hits(1), hits(5))
    got = {r.vec_id: r for r in catalog.queries()["team_similarity_all"](spark, str(tmp_path)).collect()}
    for i in range(90):
        mean = {n: np.mean([cosine[i, j] for j in range(90) if names[j] == n and j != i]) for n in set(names)}
        team = max(sorted(mean), key=lambda n: mean[n])
        assert got[i].team == team and abs(got[i].score - mean[team]) < 2e-6
