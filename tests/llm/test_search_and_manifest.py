"""Exact top-k search, ranked lexical search and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import lexical, manifest, topk

# -- exact top-k ---------------------------------------------------------------------------------------------


def _plain_top(rows, every, k):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [max(-(1 << 63), min((1 << 63) - 1, math.floor(64.0 * x))) for x in v]
            fine[i] = max(fine.get(i, q), q)
    out = []
    for i, q in fine.items():
        if i % every == 0:
            most = (1 << 63) - 1
            scores = [(-max(-most, min(most, sum(a * b for a, b in zip(q, c)))), j) for j, c in fine.items() if j != i and len(c) == len(q)]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("p", [topk.Tiles(), topk.Tiles(shard=2048, tile=64, block=7, group=256)])
def test_top_k_equals_all_products(spark, p):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(90)]  # ties by the dozen
    rows += [(2000, None), (2001, [1.0, None] * 3), (2002, [math.nan] * 6), (2004, [math.inf] * 6), (2005, [0.0] * 6), (2010, []), (2015, []), (2020, [1.0, 2.0]), (2025, [2.0, 1.0]), (None, [1.0] * 6)]
    rows += [(5, [9.0] * 6), (5, [9.0] * 6), (-10, [-0.3] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("g", F.lit("clash")).withColumn("side", F.lit(7))
    got = topk.top_k(df, F.col("id") % 5 == 0, 20, p=p)
    assert [f.simpleString() for f in got.schema] == ["query_id:bigint", "rank:int", "vec_id:bigint", "score:bigint"]
    assert sorted(map(tuple, got.collect())) == _plain_top(rows, 5, 20)


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(4)
    for scale in (1e4, 1e8, 1e17, 1e30):  # float64, long, beyond a long
        rows = [(i, [float(x) for x in rng.normal(size=3) * scale]) for i in range(60)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert sorted(map(tuple, topk.top_k(df, F.col("id") % 20 == 0, 5).collect())) == _plain_top(rows, 20, 5)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("id") % 20 == 0).count() == 0


# -- ranked lexical search -----------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain_rank(docs, items, k):
    held = [(i, Counter(_plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + (25 * c.total() * n_docs) // total
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in _plain_terms(text) if t in c)
            if s > 0:
                scores.append((-s, (1 << 63) if i is None else i, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return out


def _order(rows):
    return sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))


@pytest.mark.parametrize("p", [lexical.Search(), lexical.Search(postings=40), lexical.Search(docs=3, k=4)])
def test_rank_equals_all_scores(spark, p):
    rng = random.Random(5)
    pool = [f"W{i}" for i in range(60)] + ["été", "ÉTÉ", "naïve", "日本", "a1", "A1"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    seps = [" ", ", ", "\n", "-", "_", "\x00", "\x7f", "..."]
    text = lambda n: "".join(rng.choices(pool, weights)[0] + rng.choice(seps) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 50))) for i in range(300)]
    docs += [(400 + i, "w1 w2 w3") for i in range(60)] + [(500, None), (501, ""), (502, "  .,"), (None, "w1 w2 w3 w59"), (7, "w1 w2 w3"), (600, "w5 " * 20000)]
    items = [(i, text(rng.randrange(1, 12))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, "w1 W1 w1 w2"), (None, "w3 w59")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(5)
    asked = spark.createDataFrame([*items, (93, "w1")], "item_id long, text string").withColumn("part", F.lit(1))
    got = lexical.rank(df, asked, p)
    assert [f.simpleString() for f in got.schema] == ["item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    assert _order(map(tuple, got.collect())) == _order(_plain_rank(docs, items, p.k))


def test_rank_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(docs, items).count() == 0
    assert lexical.rank(docs, docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_shard_probes_what_it_must():
    """Lists that can't lift an unseen document to the bar aren't read whole, and the best are the same."""
    rng = np.random.default_rng(6)
    held = [5000, 40, 30]
    docs = np.concatenate([np.arange(5000), np.sort(rng.choice(5000, 40, False)), np.sort(rng.choice(5000, 30, False))]).astype(np.int32)
    row = {"ids": np.arange(5000), "lengths": np.full(5000, 50), "terms": np.array([0, 1, 2], np.int32), "held": np.array(held), "docs": docs, "tf": rng.integers(1, 4, len(docs)).astype(np.int32)}
    shard = lexical.Shard(row, np.array([3, 4000, 5000]), 5000, 250_000)
    ids, scores = shard.search(np.array([0, 1, 2]), np.array([1, 1, 1]), 10, 0)
    full = np.zeros(5000, np.int64)
    np.add.at(full, docs, shard.gain)
    want = sorted(zip(-full, range(5000)))[:10]
    assert len(ids) < 100 and sorted(zip(-scores, ids.tolist()))[:10] == want


# -- Merkle manifest -----------------------------------------------------------------------------------------


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def _siblings(levels, at):
    out = []
    for level in levels[:-1]:
        a = at // 3 * 3
        out.append(("".join(level[a:at]), "".join(level[at + 1 : a + 3])))
        at //= 3
    return out


def _plain_manifest(rows):
    def leaf(r, strip=False):
        text = r[4].replace("\n", "") if strip and r[4] is not None else r[4]
        return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(((r[0] is not None, r[0] or 0), leaf(r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _plain_levels([x[1] for x in sorted(by[s], key=lambda x: x[:2])]) for s in sources}
    top = _plain_levels([trees[s][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        for at, (_, own, r) in enumerate(sorted(by[s], key=lambda x: x[:2])):
            path = _siblings(trees[s], at) + _siblings(top, place)
            now = leaf(r, strip=r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0)
            for left, right in path:
                now = _h(left + now + right)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], _h("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 7])  # rounds of buckets: many, some, one
def test_manifest_equals_the_plain_trees(spark, levels):
    rng = random.Random(8)
    sizes = {"a": 100, None: 28, "": 27, "é": 10, "Z": 9, "+": 3, "b": 1}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            text = rng.choice([None, "", "x\ny", f"t{i}\n", "é" * 3, "w " * 5000 + "\n"])
            rows.append((i, source, rng.choice([None, "en"]), rng.choice([None, 3]), text))
    rows += [rows[0], rows[0], (5, "a", None, None, "other"), (None, "a", None, None, None), (None, None, "de", 1, "\n\n")]
    rng.shuffle(rows)
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame(rows, schema).withColumn("g", F.lit("clash")).withColumn("path", F.lit(1)).withColumn("top", F.lit(1)).repartition(3)
    got = manifest.manifest(df, manifest.crc_is_even(F.col("doc_id")), levels)
    assert sorted(map(tuple, got.collect()), key=str) == _plain_manifest(rows)


def test_manifest_of_little(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert manifest.manifest(spark.createDataFrame([], schema)).count() == 0
    row = manifest.manifest(spark.createDataFrame([(2, "s", None, 1, "a")], schema)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == _h("1:21:s-1:11:a") and row.proof_sha256 == _h("") and row.verified


def test_manifest_reads_on_where_a_run_of_buckets_ends(spark):
    rows = [(i, "abc"[i % 3], "x", i, f"{i}\n") for i in range(60_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").coalesce(1)
    got = {r.doc_id: r for r in manifest.manifest(df, manifest.crc_is_even(F.col("doc_id"))).collect()}
    want = {r[0]: r for r in _plain_manifest(rows)}
    assert all(tuple(got[i]) == want[i] for i in want) and len(got) == 60_000


# -- licence windows -----------------------------------------------------------------------------------------


def test_licence_windows_of_repeats():
    """Windows that begin or end in repeats, against all windows."""
    from pathloom.llm import licences

    rng = random.Random(10)
    for _ in range(300):
        template = [rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))]
        text = []
        while len(text) < rng.randrange(4, 40):
            text += rng.choice([template, template[:-1], ["a", "b"] * rng.randrange(1, 6), ["x"], [rng.choice("abcdefgh")]])
        want_grams, best = set(zip(template, template[1:])), None
        grams = list(zip(text, text[1:]))
        for s in range(len(grams)):
            if grams[s] not in want_grams:
                continue
            for e in range(s, len(grams)):
                own = set(grams[s : e + 1])
                dice = 2 * len(own & want_grams) / (len(own) + len(want_grams))
                if dice >= 0.8 and (best is None or dice > best[0] + 1e-12):
                    best = dice, s
        got = licences.Scanner(licences.Scan(templates=(("T", " ".join(template)),), texts=())).best("\n".join(text))
        assert (got is None) == (best is None) and (best is None or (got[1] == pytest.approx(best[0]) and got[2] == best[1] + 1)), (template, text, best, got)


def test_licences_in_very_long_texts():
    import time

    from pathloom.llm import licences

    scanner = licences.Scanner(licences.Scan())
    mit = licences.normalised(dict(licences.whole_texts())["MIT"]).decode().split()
    scattered = " filler ".join(" ".join(mit[i : i + 2]) for i in range(0, len(mit) - 1))
    began = time.time()
    text = scattered + " " + "the software " * 400_000 + " " + " ".join(mit)
    assert scanner.best(text)[:2] == ("MIT", 1.0) and len(text) > 5_000_000
    near = " ".join(["foo", *mit[:-3], "bar"])
    assert scanner.best((near + " ") * 300)[0] == "MIT"
    assert scanner.best("z" * 3_000_000 + " " + " ".join(mit))[:2] == ("MIT", 1.0)
    assert time.time() - began < 60


# -- one doc_id on half the rows -----------------------------------------------------------------------------


def test_hot_doc_id(spark, tmp_path):
    import corpus_pipeline
    from pathloom.llm import substrings, tokenfiles, tokens

    rng = random.Random(11)
    line = lambda n, tag: " ".join(f"{tag}{rng.randrange(10**6)}" for _ in range(n))
    passage = line(20, "p")
    hot = [(7, f"{line(10, 'h')} {passage} {line(10, 'i')}") for _ in range(150)] + [(7, "the same " * 20)] * 50
    rest = [(i, line(30, "r") + (" " + passage if i % 5 == 0 else "")) for i in range(100, 300)]
    df = spark.createDataFrame(hot + rest, "doc_id long, text string").withColumn("source", F.lit("s")).repartition(6)
    # passages: rows of one doc_id don't take words from each other, larger ids lose what 7 holds
    got = substrings.remove_repeats(df, substrings.Cover(megabytes=1)).collect()
    assert all((r.n_removed == 0) == (r.doc_id == 7 or r.doc_id % 5 > 0) for r in got) and len(got) == 400
    # token files: every row, in order, by the offsets read back
    files = sorted(map(tuple, tokenfiles.tokenize_to_files(df).collect()), key=lambda r: r[1])
    assert [r[0] for r in files] == sorted(d for d, _ in hot + rest) and all(a[1] + a[2] == b[1] for a, b in zip(files, files[1:]))
    # near duplicates: texts of one doc_id are told apart, and one of each group of copies stays
    kept = corpus_pipeline.near_duplicates(spark, df, None)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(set(hot + rest)) and kept.columns == df.columns


def test_elias_fano_by_parts():
    from pathloom.llm.tokenfiles import EliasFano

    rng = np.random.default_rng(12)
    for values in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 10**9, 5000)), np.arange(1000), np.sort(rng.integers(0, 40, 3000))):
        values = np.array(values, np.int64)
        f = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
        for a, b in [(0, len(values)), *(sorted(rng.integers(0, len(values) + 1, 2).tolist()) for _ in range(30))]:
            assert (f.values(a, b) == values[a:b]).all()
        assert [f.select(i) for i in range(0, len(values), 97)] == values[::97].tolist()
