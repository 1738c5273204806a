"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import htmltext, lexical, licences, manifest, mixing, neardup, neighbours, packing, substrings, tokenfiles, topk, toxicity, vecdup


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark, sf_dir):
    p = neardup.MinHash(width=3, percent=85, bands=20)
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), p)


def op2_nearest(spark, sf_dir):
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op3_near_duplicate_vectors(spark, sf_dir):
    return vecdup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op4_repeated_passages(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_token_files(spark, sf_dir):
    return tokenfiles.tokenize_to_files(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op7_licences(spark, sf_dir):
    return licences.scan_licences(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_main_text(spark, sf_dir):
    return htmltext.extract_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_mix(spark, sf_dir):
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_pack(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_top_k(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op12_manifest(spark, sf_dir):
    return manifest.manifest(_table(spark, sf_dir, "documents"), manifest.crc_is_even(F.col("doc_id")))


def op13_ranked(spark, sf_dir):
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries():
    return {k: v for k, v in globals().items() if k[:2] == "op" and k[2].isdigit()}


ORACLE_SQL: dict[str, str] = {
    "op3_near_duplicate_vectors": r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT l.b, reach.r FROM reach JOIN link l ON l.a = reach.id WHERE reach.r < l.b),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_links, min(reach.r) AS component_id, min(reach.r) = e.vec_id AS kept
FROM embeddings e JOIN reach ON reach.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id GROUP BY e.vec_id""",
    "op4_repeated_passages": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
p AS (SELECT doc_id, a, unnest(range(1, len(a) - 11)) AS i FROM w WHERE len(a) >= 13),
g AS (SELECT doc_id, i, array_to_string(a[i : i + 12], ' ') AS s FROM p),
least AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
late AS (SELECT g.doc_id, unnest(range(g.i, g.i + 13)) AS k FROM g JOIN least USING (s) WHERE least.m < g.doc_id),
gone AS (SELECT DISTINCT doc_id, k FROM late),
one AS (SELECT doc_id, unnest(a) AS x, unnest(range(1, len(a) + 1)) AS k FROM w),
kept AS (SELECT o.doc_id, string_agg(o.x, ' ' ORDER BY o.k) AS t FROM one o ANTI JOIN gone USING (doc_id, k) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(w.a) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    # components are found by passing the smallest id along the links
    "op1_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2]) END) AS g FROM w
), e AS (SELECT doc_id, unnest(g) AS x FROM s),
n AS (SELECT doc_id, len(g) AS n FROM s),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS id, doc_id AS r FROM n UNION SELECT l.b, reach.r FROM reach JOIN both_ways l ON l.a = reach.id WHERE reach.r < l.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = n.doc_id AS kept
FROM n JOIN reach ON reach.id = n.doc_id GROUP BY n.doc_id, n.n""",
}


def _licence_sql() -> str:
    quoted = ", ".join(f"({k}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for k, (n, t) in enumerate(licences.TEMPLATES))
    grams = "CASE WHEN s = '' THEN [] WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END"
    plain = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH t0 AS (SELECT k, name, {plain.format("body")} AS s FROM (VALUES {quoted}) v(k, name, body)),
t1 AS (SELECT *, string_split(s, ' ') AS w FROM t0), t AS (SELECT k, name, {grams} AS g FROM t1),
l0 AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS line FROM documents),
l1 AS (SELECT doc_id, line, {plain.format("raw")} AS s FROM l0), l2 AS (SELECT *, string_split(s, ' ') AS w FROM l1),
l AS (SELECT doc_id, line, {grams} AS g FROM l2),
d AS (SELECT doc_id, line, name, k, 2.0::DOUBLE * len(list_intersect(l.g, t.g)) / (len(l.g) + len(t.g)) AS dice FROM l JOIN t ON len(l.g) BETWEEN 1 AND 100),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, line, name, k) AS r FROM d WHERE dice >= 0.8)
SELECT x.doc_id, b.name AS licence, b.dice, CAST(b.line AS BIGINT) AS line FROM documents x LEFT JOIN b ON b.doc_id = x.doc_id AND b.r = 1"""


ORACLE_SQL["op7_licences"] = _licence_sql()

ORACLE_SQL["op11_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

ORACLE_SQL["op13_ranked"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a, row_number() OVER () AS k FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS times FROM b GROUP BY 1, 2),
c AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(a)) AS BIGINT) AS l FROM d WHERE len(a) > 0),
x AS (SELECT k, unnest(a) AS t FROM d), f AS (SELECT k, t, count(*) AS tf FROM x GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000.0::DOUBLE * ln((2.0::DOUBLE * max(c.n) + 2.0::DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY t),
m AS (SELECT k, doc_id, 75 + (25 * len(a) * c.n) // c.l AS m FROM d, c WHERE len(a) > 0),
s AS (SELECT q.item_id, m.k, m.doc_id, CAST(sum(q.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * m.m))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t) JOIN m ON m.k = f.k GROUP BY 1, 2, 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""


def _manifest_sql(levels: int = 14, source_levels: int = 8) -> str:
    """Leaves, then every level of the sources' trees and of the tree above, side by side; a group that is down to one node stays as it is."""
    sql = []

    def fold(name: str, count: int) -> None:  # {name}0 (g, k, h) to {name}{count}, and the siblings of every level
        for x in range(count):
            sql.append(f"{name}c{x} AS (SELECT g, count(*) AS n FROM {name}{x} GROUP BY g)")
            sql.append(
                f"{name}s{x} AS MATERIALIZED (SELECT a.g, a.k, coalesce(string_agg(o.h, '' ORDER BY o.k) FILTER (o.k < a.k), '') AS l, coalesce(string_agg(o.h, '' ORDER BY o.k) FILTER (o.k > a.k), '') AS r "
                f"FROM {name}{x} a JOIN {name}{x} o ON o.g = a.g AND o.k // 3 = a.k // 3 JOIN {name}c{x} c ON c.g = a.g AND c.n > 1 GROUP BY a.g, a.k)"
            )
            sql.append(f"{name}{x + 1} AS MATERIALIZED (SELECT g, k // 3 AS k, CASE WHEN max(c.n) > 1 THEN sha256(string_agg(h, '' ORDER BY k)) ELSE max(h) END AS h FROM {name}{x} JOIN {name}c{x} c USING (g) GROUP BY g, k // 3)")

    def walk(name: str, count: int, first: str, start: str) -> str:  # the row's digest and its siblings' digests, level by level
        for x in range(count):
            k = f"f.{'k' if name == 'n' else 'place'} // {3**x}"
            join = f"LEFT JOIN {name}s{x} s ON s.g = {'f.g' if name == 'n' else "''"} AND s.k = {k}"
            sql.append(f"{start}{x} AS MATERIALIZED (SELECT f.* REPLACE (CASE WHEN s.k IS NULL THEN cur ELSE sha256(s.l || cur || s.r) END AS cur, proof || coalesce(s.l || s.r, '') AS proof) FROM {first} f {join})")
            first = f"{start}{x}"
        return first

    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
    head = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda i: (ord(c) >> i) & 1)))"
    crc = f"xor(list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295)"
    sql.append(f"d AS (SELECT doc_id, coalesce('+' || source, '') AS g, sha256({head} || {field.format('text')}) AS leaf, sha256({head} || {field.format('x')}) AS stripped, {crc} % 2 = 0 AS even FROM (SELECT *, replace(text, chr(10), '') AS x FROM documents))")
    sql.append("e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM d)")
    sql.append("n0 AS (SELECT g, k, leaf AS h FROM e)")
    fold("n", levels)
    sql.append(f"o AS MATERIALIZED (SELECT g AS source, row_number() OVER (ORDER BY g) - 1 AS place, h AS subroot FROM n{levels})")
    sql.append("m0 AS (SELECT '' AS g, place AS k, subroot AS h FROM o)")
    fold("m", source_levels)
    sql.append("f AS (SELECT e.doc_id, e.g, e.k, e.leaf, o.place, o.subroot, CASE WHEN even THEN stripped ELSE leaf END AS cur, '' AS proof FROM e JOIN o ON o.source = e.g)")
    last = walk("m", source_levels, walk("n", levels, "f", "p"), "u")
    return f"WITH {', '.join(sql)} SELECT doc_id, leaf, subroot, m{source_levels}.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = m{source_levels}.h AS verified FROM {last}, m{source_levels}"


ORACLE_SQL["op12_manifest"] = _manifest_sql()


def oracle_sql():
    return dict(ORACLE_SQL)
