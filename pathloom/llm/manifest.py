"""A Merkle manifest of a dataset: leaves by row, a tree of three children a node for each source, and a tree of the sources' roots.

Spark numbers the leaves and deals them into aligned buckets of 3 ** LEVELS; on the executors DuckDB runs the levels of whole buckets (an
ordered string_agg and a sha256 a level). The buckets' roots are the next round's leaves, until a source has one root.
"""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, written

FAN = 3
#: Levels of a bucket: 2187 leaves, whose subtrees share no node with another bucket's.
LEVELS = 7
#: Rows that DuckDB gets at once: whole buckets, of which one may be small.
RUN_ROWS = 16_384
_STEP = T.StructType([T.StructField("l", T.StringType()), T.StructField("r", T.StringType())])
_PATH = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))


def encoded(*values: Column) -> Column:
    """The values one after another: `-` for a null, else the count of UTF-8 bytes, a colon, and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` (g, …) as a table with pos, the place within g by `order`, and n, the rows of g. Ranges of all rows are sorted apart; a row for
    each range and group that meet gives the places before it, so a group may have any share of the rows."""
    ranges = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ranges = written(ranges.withColumn("__at", F.monotonically_increasing_id()), name)
    ranges_at = ranges.withColumn("__part", F.shiftright("__at", 33)).withColumn("__row", F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at")
    starts = ranges_at.groupBy("g", "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("g").orderBy("__part")
    starts = starts.withColumn("n", F.sum("__n").over(Window.partitionBy("g"))).withColumn("__skip", F.sum("__n").over(before) - F.col("__n") - F.col("__first"))
    out = ranges_at.join(starts.select("g", "__part", "n", "__skip"), ["g", "__part"])
    return out.withColumn("pos", F.col("__row") + F.col("__skip")).drop("__part", "__row", "__skip")


def _engine() -> duckdb.DuckDBPyConnection:
    global _connection
    if _connection is None:
        _connection = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
    return _connection


_connection: duckdb.DuckDBPyConnection | None = None


def bucket_sql(levels: int) -> str:
    """The levels of all buckets in `leaves` (i, b, k, height, h): rows (i, path, top). A bucket of less height is through earlier."""
    sql = ["n0 AS MATERIALIZED (SELECT b, k, height, h FROM leaves)"]
    for x in range(levels):
        sql.append(
            f"s{x} AS MATERIALIZED (SELECT a.b, a.k, coalesce(string_agg(o.h, '' ORDER BY o.k) FILTER (o.k < a.k), '') AS l, "
            f"coalesce(string_agg(o.h, '' ORDER BY o.k) FILTER (o.k > a.k), '') AS r "
            f"FROM n{x} a JOIN n{x} o ON o.b = a.b AND o.k // {FAN} = a.k // {FAN} WHERE a.height > {x} GROUP BY a.b, a.k)"
        )
        sql.append(f"n{x + 1} AS MATERIALIZED (SELECT b, k // {FAN} AS k, height, sha256(string_agg(h, '' ORDER BY k)) AS h FROM n{x} WHERE height > {x} GROUP BY b, k // {FAN}, height)")
    tops = " UNION ALL ".join(f"SELECT b, h FROM n{x} WHERE height = {x}" for x in range(levels + 1))
    steps = ", ".join(f"CASE WHEN s{x}.b IS NOT NULL THEN {{'l': s{x}.l, 'r': s{x}.r}} END" for x in range(levels))
    joins = " ".join(f"LEFT JOIN s{x} ON s{x}.b = leaves.b AND s{x}.k = leaves.k // {FAN**x}" for x in range(levels))
    path = f"list_filter([{steps}], lambda x: x IS NOT NULL)" if levels else "CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[])"
    return f"WITH {', '.join(sql)}, tops AS ({tops}) SELECT leaves.i, {path} AS path, tops.h AS top FROM leaves {joins} JOIN tops ON tops.b = leaves.b ORDER BY leaves.i"


def fold_buckets(rows: pa.Table, levels: int = LEVELS) -> pa.Table:
    """`rows` (g, bucket, pos, n, h, …), whole buckets one after another, with path (siblings left and right, level by level) and top."""
    size = FAN**levels
    n, pos = rows.column("n").to_numpy(), rows.column("pos").to_numpy()
    held, height = np.minimum(n, size), np.zeros(len(n), np.int64)
    while (held > 1).any():
        height += held > 1
        held = -(-held // FAN)
    height = np.where(n > size, levels, height)
    number = np.concatenate([[0], np.cumsum(_edges(rows))])
    leaves = pa.table({"i": np.arange(len(n)), "b": number, "k": pos % size, "height": height, "h": rows.column("h")})
    engine = _engine()
    engine.register("leaves", leaves)
    out = engine.sql(bucket_sql(int(height.max()))).to_arrow_table()
    engine.unregister("leaves")
    return rows.append_column("path", out.column("path").cast(_PATH)).append_column("top", out.column("top").cast(pa.string()))


def _edges(rows: pa.Table) -> np.ndarray:
    """Where a row's bucket isn't that of the row before."""
    new = [pc.not_equal(rows.column(c).slice(1), rows.column(c).slice(0, len(rows) - 1)) for c in ("g", "bucket")]
    return pc.or_(*new).to_numpy(zero_copy_only=False) if len(rows) > 1 else np.empty(0, bool)


def _round(nodes: DataFrame, name: str, levels: int) -> DataFrame:
    """`nodes` (g, pos, n, h, …), folded bucket by bucket and stored."""
    nodes = nodes.withColumn("bucket", F.expr(f"pos div {FAN**levels}"))
    nodes = nodes.repartition("g", "bucket").sortWithinPartitions("g", "bucket", "pos")
    schema = T.StructType([*nodes.schema.fields, T.StructField("path", T.ArrayType(_STEP)), T.StructField("top", T.StringType())])

    def work(batches):
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            rows += len(batch)
            if rows >= RUN_ROWS:
                table = pa.concat_tables(waiting).combine_chunks()
                cuts = np.flatnonzero(_edges(table)) + 1
                cut = int(cuts[-1]) if len(cuts) else 0  # the last bucket may go on
                if cut:
                    yield from fold_buckets(table.slice(0, cut), levels).to_batches()
                waiting, rows = [table.slice(cut)], len(table) - cut
        if rows:
            yield from fold_buckets(pa.concat_tables(waiting).combine_chunks(), levels).to_batches()

    return written(nodes.mapInArrow(work, schema), name)


def tree(rows: DataFrame, name: str, levels: int = LEVELS) -> DataFrame:
    """`rows` (g, pos, n, h, …) with path, the siblings from leaf to root, and top, the root of g."""
    rounds = [_round(rows, name, levels)]
    size = FAN**levels
    while not rounds[-1].filter(F.col("n") > size).isEmpty():
        up = rounds[-1].filter(F.col("pos") % size == 0).select("g", F.col("bucket").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("h"))
        rounds.append(_round(up, f"{name}-{len(rounds)}", levels))
    out = rounds.pop()
    while rounds:
        outer = out.select("g", F.col("pos").alias("bucket"), F.col("path").alias("__outer"), F.col("top").alias("__top"))
        out = rounds.pop().drop("top").join(outer, ["g", "bucket"])
        out = out.withColumn("path", F.concat("path", "__outer")).withColumnRenamed("__top", "top").drop("__outer")
    return out.drop("bucket")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, s: _digest(F.concat(s["l"], at, s["r"])))


def proofs(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Rows (id, leaf, subroot, root, path, …) from rows (source, id, leaf, …): the siblings of every leaf via its source's root to the
    root of all. Leaves ascend by id within a source, null first, ties by leaf; sources by their bytes, null first."""
    leaves = leaves.withColumn("g", F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))).withColumn("h", F.col("leaf"))
    inner = tree(_numbered(leaves, ["id", "h"], "merkle-leaves"), "merkle-inner", levels)
    subroots = inner.filter(F.col("pos") == 0).select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("top").alias("h"))
    top = tree(_numbered(subroots, ["of"], "merkle-sources"), "merkle-outer", levels)
    top = top.select(F.col("of").alias("g"), F.col("path").alias("__outer"), F.col("top").alias("root"))
    out = inner.withColumnRenamed("top", "subroot").join(top, "g")
    return out.withColumn("path", F.concat("path", "__outer")).drop("__outer", "g", "pos", "n", "h")


def manifest(docs: DataFrame, tamper: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one for each row of `docs` (doc_id, source, lang, n_chars, text).

    `tamper`, a condition over `docs`, says which texts lose their line feeds before their leaf is folded again with the siblings of the
    untouched dataset; `verified` is whether that gives the root.

    Cases: nulls in any column are encoded as such; a null doc_id comes first, a null source is a source of its own. Rows that repeat a
    doc_id within a source come by their leaf, so equal rows are interchangeable leaves. Long texts never leave the scan: only digests are
    shuffled. An empty table gives no rows. Other columns don't matter, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    leaf = _digest(encoded(*fields, text))
    changed = leaf if tamper is None else F.when(F.coalesce(tamper, F.lit(False)), _digest(encoded(*fields, F.replace(text, F.lit("\n"), F.lit(""))))).otherwise(leaf)
    # stored, for sorting by ranges reads its input twice and texts are long
    leaves = written(docs.select("source", F.col("doc_id").alias("id"), leaf.alias("leaf"), changed.alias("changed")), "merkle-digests")
    out = proofs(leaves, levels).withColumn("folded_root", folded(F.col("changed"), F.col("path")))
    proof = _digest(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def crc_is_even(doc_id: Column) -> Column:
    """Whether 2 divides the unsigned crc32 of the decimal id; null has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
