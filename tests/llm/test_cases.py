"""The cases that the docstrings name, for the operators that test_llm.py doesn't try them on; brute-force versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import common, components, htmltext, licences, mixing, neardup, neighbours, packing, substrings, tokenfiles, tokens, toxicity, vecdup

DOCS = "doc_id long, text string, source string, n_chars long"


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neardup.near_duplicates(docs).count() == 0
    assert substrings.remove_repeats(docs).count() == 0
    assert neighbours.nearest(vectors).count() == 0
    assert vecdup.near_duplicate_vectors(vectors).count() == 0
    assert licences.scan_licences(docs).count() == 0 == licences.scan_licences(docs, every=True).count()
    assert mixing.mix(docs).count() == 0 == packing.pack(docs).count()
    assert toxicity.score_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
    assert htmltext.extract_text(docs.withColumnRenamed("text", "html")).count() == 0


def _jaccard(a, b, width=5):
    shingles = lambda t: {tuple(t.split()[i : i + width]) for i in range(len(t.split()) - width + 1)}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_near_duplicates_of_a_band_with_many_components(spark):
    # copies of one text with so many changes that their similarities scatter around the threshold: bands hold many components
    rng = random.Random(9)
    base = words(rng, 120, 5000)
    texts = []
    for _ in range(150):
        t = list(base)
        for _ in range(rng.randrange(0, 6)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("id", F.lit("clash"))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if _jaccard(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    for p in (neardup.MinHash(), neardup.MinHash(chunk=16, set_bytes=4096)):  # the latter cuts groups into many blocks
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, p).collect()}
        assert [got[i] for i in range(len(texts))] == root


def test_components_of_long_paths_and_stars(spark):
    n = 400
    path = [(i, i + 1) for i in range(n - 1)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    links = spark.createDataFrame(path + star + [(None, 3), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(n)} | {1000 + i: 1000 for i in range(500)}


def test_repeated_passages_without_id(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    df = spark.createDataFrame([(None, passage), (2, "a " + passage), (2, passage), (1, passage + " b"), (3, None)], "doc_id long, text string").withColumn("block", F.lit(1))
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.text) for r in substrings.remove_repeats(df, substrings.Cover(megabytes=1)).collect() if r.text)
    assert got == [(0, 30, 0, passage), (1, 31, 0, passage + " b"), (2, 30, 30, ""), (2, 31, 30, "a")] or [g[:3] for g in got] == [(0, 30, 0), (1, 31, 0), (2, 31, 30)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pathloom_blocks")]


def test_vectors_with_repeated_ids_and_ties(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.99, 0.05]), (2, [0.98, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, [-1.0, 0.0]), (5, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash")).withColumn("component", F.lit(1))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vecdup.near_duplicate_vectors(df).collect())
    assert got == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 3, 1, False), (5, 1, 5, True), (5, 1, 5, True)]
    found = neighbours.nearest(df.withColumn("leaf", F.lit(1)), every=1, k=2).collect()
    of = lambda q: [(r.vec_id, round(r.score, 9)) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
    assert of(1) == [(4, 1.0), (2, 0.98)] and of(4) == [(1, 1.0), (2, 0.98)] and of(3)[0] == (2, 0.1)
    # many equal vectors: ties go to the smaller id
    same = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(3000)], "vec_id long, embedding array<float>").repartition(4)
    tied = neighbours.nearest(same, every=1000).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in tied if r.query_id == 0) == [(0, i, i) for i in range(1, 21)]
    assert sorted(r.vec_id for r in tied if r.query_id == 2000) == list(range(20))


def test_blocks_of_a_component(spark):
    rng = np.random.default_rng(4)
    x = np.eye(8)[0] + 0.12 * rng.standard_normal((900, 8))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    root = vecdup._forest(len(x), *np.nonzero(link))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vecdup.near_duplicate_vectors(df, p=vecdup.Passes(chunk=100)).collect()}
    assert all((got[i].n_links, got[i].component_id) == (link[i].sum() - 1, root[i]) for i in range(len(x)))


def test_forest_alone_finds_neighbours(spark):
    # 50 000 vectors, of which trees are fitted on a quarter: every result comes from a searched leaf
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((2000, 32))
    x = (centres[rng.integers(0, 2000, 50_000)] + 0.6 * rng.standard_normal((50_000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    p = neighbours.Forest(sample=12_500)
    found = {}
    for r in neighbours.nearest(df, every=500, p=p).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    x = x.astype(float)
    hits = 0
    for q in range(0, 50_000, 500):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argpartition(-score, 20)[:20].tolist()))
        assert len(found[q]) == 20
    assert hits >= 0.9 * 20 * 100
    index, budget, _ = neighbours.fit(neighbours.usable(df, "vec_id", "embedding"), p, 20)
    leaf = index.leaf_of(x)
    shares = [index.chosen(index.costs(x[q : q + 1])[0], budget, 21)[np.arange(12)[None, :], leaf].any(1).mean() for q in range(0, 50_000, 2500)]
    assert np.mean(shares) < 0.4


def test_queue_and_costs_agree():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 8))
    index = neighbours.Index(np.arange(500), x, neighbours.Forest(trees=3).at(500))
    for q in x[:5]:
        cost = index.costs(q[None, :])[0]
        mask = index.chosen(cost, 20, 1)
        queued = index.queued(q, 20)
        assert sorted(round(float(cost[t, n]), 4) for t, n in queued) == sorted(np.round(cost[mask], 4).astype(float).round(4).tolist())


def test_licences_cases(spark):
    texts = dict(licences.whole_texts())
    both = texts["MIT"] + "\n\nsome code\n\n" + "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, both), (1, both), (2, "x " * 200_000 + "Released under the MIT License."), (3, None), (4, ""), (None, "Released under the\n MIT   License")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licence", F.lit("clash")).withColumn("dice", F.lit(0))
    best = licences.scan_licences(df).collect()
    assert sorted(((r.doc_id or 0), r.licence or "", r.line or 0) for r in best) == [(0, "MIT", 1), (1, "MIT", 1), (1, "MIT", 1), (2, "MIT", 1), (3, "", 0), (4, "", 0)]
    every = sorted(((r.doc_id or 0), r.licence) for r in licences.scan_licences(df, every=True).collect())
    assert every == [(0, "MIT"), (1, "GPL-3.0"), (1, "GPL-3.0"), (1, "MIT"), (1, "MIT"), (2, "MIT")]


def test_mixing_of_repeated_rows_and_clashes(spark):
    rows = [(1, "a b c", "s", i) for i in range(500)] + [(2, "d e", "t", 1), (None, "n n n", None, 3), (3, "", "t", 4), (4, "long " * 50_000, "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _i int").withColumn("_p", F.lit(1)).withColumn("row", F.lit(2)).withColumn("copies", F.lit(3))
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(rows)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    count = lambda d: sorted(((r.doc_id or 0), r._i, r["count"]) for r in d.groupBy("doc_id", "_i").count().collect())
    first = count(mixed)
    assert first == count(mixing.mix(df.repartition(5))) and sum(c for *_, c in first) == sum(r.copies for r in plan)
    copies = [r.copies for r in plan if r.doc_id == 1]
    assert max(copies) - min(copies) <= 1


def _rounded(rows, weights, cap, fan_in):
    """The trade of one pair, by the rule in words: the same chances, so the sum of probability times size stays."""
    a, b, u = rows
    d1, d2 = min((1 - a[1]) * a[0], b[1] * b[0]), min(a[1] * a[0], (1 - b[1]) * b[0])
    if u * (d1 + d2) < d2:
        return a[1] + d1 / a[0], b[1] - d1 / b[0]
    return a[1] - d2 / a[0], b[1] + d2 / b[0]


def test_mixing_pair_trades(spark):
    # one source of two documents: the outcome must be one of the two that the rule allows, with the uniform that the hash gives
    rng = random.Random(2)
    for trial in range(4):
        n1, n2 = rng.randrange(5, 40), rng.randrange(5, 40)
        df = spark.createDataFrame([(1, "a " * n1, "s"), (2, "b " * n2, "s"), (3, "c " * 50, "t")], "doc_id long, text string, source string")
        plan = {r.doc_id: r for r in mixing.mix_plan(df).collect()}
        target = plan[1].target
        p = target / (n1 + n2)
        whole, part = int(p), p - int(p)
        outcomes = set()
        for u in (0.0, 1.0):
            x, y = _rounded(((n1, part), (n2, part), u), None, None, None)
            outcomes |= {(whole + round(i), whole + round(j)) for i, j in [(x, y)]}
            x, y = _rounded(((n2, part), (n1, part), u), None, None, None)
            outcomes |= {(whole + round(j), whole + round(i)) for i, j in [(x, y)]}
        assert (plan[1].copies, plan[2].copies) in outcomes


def test_packing_against_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    rows = [(i, " ".join(words(rng, rng.randrange(1, 900)))) for i in range(60)] + [(60, None), (61, ""), (62, "same text"), (62, "same text"), (None, "lost"), (63, "long words " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("length", F.lit("clash"))
    plain = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    key = lambda d: -1 if d is None else d
    want = sorted((key(d), [*plain.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows)
    ids = {d: x for d, x in want}
    got = packing.pack(df).collect()
    covered = {}
    for r in got:
        x = ids[key(r.doc_id)]
        assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4"))
        covered.setdefault(key(r.doc_id), []).append((r.start, r.length))
    for d, pieces in covered.items():
        times = 2 if d == 62 else 1
        assert sorted(i for s, n in pieces for i in range(s, s + n)) == sorted(list(range(len(ids[d]))) * times)
    assert sorted(covered) == sorted(ids)
    assert packing.pack(df.filter("doc_id in (60, 61)")).agg(F.sum("length")).first()[0] == 2


def test_token_files_with_clashing_columns(spark):
    df = spark.createDataFrame([(2, "b c", "x"), (1, None, "y"), (None, "z", "x"), (1, "again", "y")], "doc_id long, text string, name string").withColumn("start", F.lit(9))
    got = sorted(tokenfiles.tokenize_to_files(df).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 1, 2] and got[0].start == 0 and got[1].n_tokens == 1


def test_toxicity_cases(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, 30)) + (" you idiot" if i % 5 == 0 else "")) for i in range(400)]
    rows += [(500, "you idiot " * 40_000), (501, "same words"), (501, "same words"), (None, "x"), (502, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("y", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(df, labels).collect()
    assert len(got) == len(rows) and {r.predicted for r in got if r.doc_id == 500} == {1}
    assert len({r.score for r in got if r.doc_id == 501}) == 1
    ranked = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in ranked)
    one = toxicity.score_toxicity(df, labels.filter("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in one)
    # rare labels are kept by the bounded sample
    rare = toxicity.score_toxicity(df, spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(400)], "doc_id long, toxic int"), toxicity.Toxicity(rows=40))
    assert rare.count() == len(rows)


def test_scratch(spark):
    df = common.written(spark.range(5), "sweep-me")
    assert df.count() == 5 and common.sweep(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(df.scratch).count()


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "one two three", None, None, 13), (2, "one two three", None, None, 13)], schema)
    for name, table in (("empty", spark.createDataFrame([], schema)), ("odd", odd.withColumn("copies", F.lit(1)).withColumn("_i", F.lit(2)).withColumn("score", F.lit("s")))):
        for stage_name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path))
            assert out.columns == table.columns, (name, stage_name)
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).count()
