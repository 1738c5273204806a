"""Operators on small tables: against brute force, by round trips, and on nulls, empty tables, ties and clashing columns."""

import hashlib
import random
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import htmltext, licences, mixing, neardup, neighbours, packing, substrings, tokenfiles, tokens, toxicity, vecdup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    base, passage = words(rng, 90), words(rng, 30, 5000)
    rows = []
    for i in range(60):
        text = words(rng, rng.randrange(5, 120))
        if i % 5 == 0:
            text = list(base)
            for _ in range(i % 4):
                text[rng.randrange(len(text))] = "x"
        if i % 7 == 0:
            text = text[:10] + passage + text[10:]
        rows.append((i, " ".join(text), "en", None if i % 11 == 0 else f"s{i % 3}", 1))
    rows += [(60, None, None, None, None), (61, "", "en", "s1", 0), (62, " \n\t ", "en", "s1", 3), (63, "one two", "en", "s0", 7), (63, "one two", "en", "s0", 7), (None, "lost " * 20, "en", "s2", 9), (64, "w1 " * 30_000, "en", "s2", 9)]
    return spark.createDataFrame(rows, DOCS), rows


def shingles(text, k):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, width, percent):
    df, rows = docs
    got = neardup.near_duplicates(df.withColumn("bands", F.lit(1)), neardup.MinHash(width=width, percent=percent)).collect()
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, shingles(t, width))
    root = {i: i for i in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)


def test_repeated_passages(docs):
    df, rows = docs
    got = {r.doc_id: r for r in substrings.remove_repeats(df.withColumn("n_words", F.lit("clash"))).collect() if r.doc_id is not None}
    first = {}
    for i, t, *_ in rows:
        w = (t or "").split()
        for k in range(len(w) - 12):
            if i is not None:
                first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    for i, t, *_ in rows:
        if i is None:
            continue
        w = (t or "").split()
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
        assert got[i].text == (kept if gone else t)


def test_cover():
    with pytest.raises(ValueError):
        substrings.Cover(offsets=(0, 1))


def test_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 16))
    x[100:160] = x[0] + 0.05 * rng.standard_normal((60, 16))
    x[200:210] = x[1]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (None, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    got = {r.vec_id: r for r in vecdup.near_duplicate_vectors(df).collect() if r.vec_id is not None}
    assert len(got) == 304 and all(got[i].n_links == 0 and got[i].kept for i in (300, 301, 302, 303))
    right = sum(got[i].n_links == link[i].sum() - 1 for i in range(300))
    assert right >= 297 and got[150].component_id == 0 and got[205].component_id == 1
    score = np.round(x @ x.T, 9)
    np.fill_diagonal(score, -np.inf)
    found = {}
    for r in neighbours.nearest(df).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = r
    assert sorted(found) == list(range(0, 300, 20))
    for q, ranked in found.items():
        best = sorted(range(300), key=lambda i: (-score[q, i], i))[:20]
        assert len(ranked) == 20 and len(set(best) & {r.vec_id for r in ranked.values()}) >= 19
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert neighbours.nearest(few).count() == 2


def test_vectors_of_a_hot_region(spark):
    # one dense region below the threshold, in which pairs are planted above it
    rng, dim, n, planted = np.random.default_rng(6), 384, 3000, 300
    noise = rng.standard_normal((n + planted, dim)) / np.sqrt(dim)
    x = np.sqrt(0.84) * np.eye(dim)[0] + np.sqrt(0.16) * noise
    turn = rng.standard_normal((planted, dim))
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(x)
    turn = unit(turn - (turn * x[:planted]).sum(1, keepdims=True) * x[:planted])
    x[n:] = 0.905 * x[:planted] + np.sqrt(1 - 0.905**2) * turn
    link = unit(x) @ unit(x).T >= 0.9
    root = vecdup._forest(len(x), *np.nonzero(link))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    for p in (vecdup.Passes(), vecdup.Passes(batch=8, chunk=500)):
        got = {r.vec_id: r for r in vecdup.near_duplicate_vectors(df, p=p).collect()}
        assert all((got[i].n_links, got[i].component_id) == (link[i].sum() - 1, root[i]) for i in range(len(x)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens(name):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = ["", "a  b\n\n c", "don't, l'ami ... 1,000.5", "<|endoftext|> x", "nul\0 x", "Ὀδυσσεύς ΑΣ. ß é", "\x1c a b ", "漢字，かな。"]
    texts += ["".join(rng.choices("ab é,.'\n  \t1%|< ßΣ́", k=rng.randrange(1, 40))) for _ in range(500)]
    plain = Tokenizer.from_file(tokens.default_path(name))
    for text, ids in zip(texts, tokens.ChunkEncoder(tokens.default_path(name), limit=50).encode(texts)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_elias_fano():
    rng = np.random.default_rng(2)
    for values in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 10**7, 3000))):
        e = tokenfiles.EliasFano.from_bytes(tokenfiles.EliasFano.of(np.array(values, np.int64)).to_bytes())
        assert e.all().tolist() == list(values) and [e.select(i) for i in range(0, len(values), 37)] == list(values)[::37]
    data = tokenfiles.encode_file([None, 3, 3, 9], [np.array(v, np.uint32) for v in ([1], [70_000, 1], [1], [4, 5, 1])])
    f = tokenfiles.TokenFile(data)
    assert f.doc_ids() == [None, 3, 3, 9] and [f[i].tolist() for i in range(4)] == [[1], [70_000, 1], [1], [4, 5, 1]]


def test_token_files(docs):
    df, rows = docs
    got = sorted(tokenfiles.tokenize_to_files(df).collect(), key=lambda r: r.start)
    ids = list(tokens.encoder(tokens.default_path("word_bpe_49k.json")).encode([t for _, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]))
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(x.astype("<u4"))) for x in ids]
    assert [r.start for r in got] == [0, *np.cumsum([len(x) for x in ids])[:-1].tolist()]
    assert tokenfiles.tokenize_to_files(df.limit(0)).count() == 0


def test_packing(docs):
    df, rows = docs
    got = packing.pack(df).collect()
    ids = tokens.encoder(tokens.default_path("byte_bpe_50k.json"))
    total = sum(len(x) for x in ids.encode([t for _, t, *_ in rows]))
    assert sum(r.length for r in got) == total
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    pad = 0
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        pad += 2048 - at if at & (at - 1) else 0
    assert pad <= 0.02 * total and packing.pack(df.limit(0)).count() == 0


def test_mixing(docs):
    df, rows = docs
    got = mixing.mix_plan(df).collect()
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size.values()))
    while free:  # shares by weight; what goes over a cap is shared again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        for s in over or free:
            target[s] = 3.0 * size[s] if over else level * weight[s]
            left -= target[s]
        free -= over or free
    assert len(got) == len(rows) and all(0 <= r.copies <= 3 for r in got)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(target[s]) and mine[0].source_size == size[s]
        assert abs(sum(r.copies * r.size for r in mine) - target[s]) <= max(r.size for r in mine)
    again = mixing.mix_plan(df.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), r.h, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(df).count() == sum(r.copies for r in got) and mixing.mix_plan(df.limit(0)).count() == 0


def test_toxicity(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = words(rng, rng.randrange(8, 60))
        if toxic:
            text[::7] = [f"zoq{rng.randrange(1000)}" if i % 12 else "idiot" for _ in text[::7]]
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame([*rows, (None, None, "x"), (900, "", "x")], "doc_id long, text string, score string")
    got = toxicity.score_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == int(r.doc_id % 6 == 0) for r in held) >= 0.95 * len(held)
    none = toxicity.score_toxicity(df, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(none) == 602


def test_main_text(spark):
    page = (
        '<html><head><title>T</title></head><body><div class="cookie-notice">We use cookies here</div><nav><a href=x>Home</a></nav><article><h1>Head &amp; line</h1><p>First  <b>para</b>\ngraph.<br>'
        '<p>Second &am &copy;</p><div class="ad">Buy now</div><script>var a="</p>";</script><aside>Aside</aside></article><div id="comments"><p>I liked it</p></div><footer>F</footer>'
    )
    assert htmltext.main_text(page) == "Head & line\n\nFirst para graph.\n\nSecond &am ©"
    df = spark.createDataFrame([(1, "u", page, 5), (2, None, None, None), (3, "u", "<p", 1), (4, "u", "", 1)], "page_id long, url string, html string, n_chars int")
    got = {r.page_id: r for r in htmltext.extract_text(df).collect()}
    assert got[1].n_chars == len(got[1].text) and got[2].text == "" == got[4].text
    tree, (x, y) = htmltext.trained(), htmltext.training_rows()
    assert all((tree(r) >= 0.5) == bool(t) for r, t in zip(x, y))


def test_licences(spark):
    df = spark.createDataFrame([(1, "intro\nReleased under the MIT License.\nend"), (2, "licensed under the apache licence, version 2.0"), (3, None), (4, "no licence here"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(df).collect()}
    assert (got[1].licence, got[1].dice, got[1].line) == ("MIT", 1.0, 2) and all(got[i].licence is None for i in (3, 4, 5))


def test_licences_across_lines(spark):
    notices, whole = dict((n, t) for n, t in licences.TEMPLATES), dict(licences.whole_texts())
    wrap = lambda t, start="": "\n".join(start + x for x in textwrap.wrap(t, 78 - len(start)))
    texts = [(n, wrap(t)) for n, t in notices.items()] + [(n, "# a\n#\n" + wrap(t, "# ") + "\ncode = 1") for n, t in whole.items()]
    texts += [("MIT", "Some words before. Released under the MIT License. And many other words that follow on the same line.")]
    texts += [("MIT", "Copyright (c) A. Author " + " ".join(whole["MIT"].split()) + " The end."), ("BSD-3-Clause", whole["BSD-3-Clause"].replace("copyright holder", "Foo Inc")), (None, "a\nlicense\nb " * 50)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(df).collect()}
    assert [got[i].licence for i in range(len(texts))] == [n for n, _ in texts]
    assert all(got[i].dice == 1.0 for i in range(len(notices) + len(whole) + 2)) and {got[len(notices) + i].line for i in range(len(whole))} == {3}


def test_licence_windows():
    # every window of a text, by brute force
    rng, words = random.Random(4), "abcde"
    for _ in range(300):
        template, text = [[rng.choice(words) for _ in range(n)] for n in (rng.randrange(2, 9), rng.randrange(2, 40))]
        grams = lambda w: set(zip(w, w[1:]))
        g, best = grams(template), (0.0, 0)
        for s in range(len(text) - 1):
            for e in range(s + 2, len(text) + 1):
                w = grams(text[s:e])
                dice = 2.0 * len(g & w) / (len(g) + len(w))
                best = max(best, (dice, -s))
        got = licences.Scanner(licences.Scan(templates=(("T", " ".join(template)),), texts=())).best("\n".join(text))
        assert got is None if best[0] < 0.8 else got[:2] == ("T", best[0])


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    df, rows = docs
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    cur = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        cur = stage(spark, cur, str(tmp_path))
        assert cur.columns == df.columns, name
        cur.write.parquet(str(tmp_path / name))
        cur = spark.read.parquet(str(tmp_path / name))
    out = corpus_pipeline.STAGES[-1][1](spark, cur, str(tmp_path))
    total = sum(len(x) for x in tokens.encoder(tokens.default_path("byte_bpe_50k.json")).encode([r.text for r in cur.select("text").collect()]))
    assert out.agg(F.sum("length")).first()[0] == total
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == total


def test_pipeline_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(12)
    a, b, c, d, e = (" ".join(words(rng, 80, 5000)) for _ in range(5))
    rows = [(1, a, "x"), (1, a, "y"), (1, a, "x"), (2, b, "x"), (3, b + " more", "x"), (3, c, "x"), (4, d, "x"), (None, e, "x"), (None, e, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, df, None).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, a), (2, b), (3, c), (4, d), (0, e), (0, e)])
