"""Near-duplicate embeddings by sorted projection passes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, salted, written
from .components import connected_components
from .vectors import matrix, unusable, usable


@dataclass(frozen=True)
class Passes:
    """Each pass orders the vectors by `bits` random signs, concatenated, and compares each vector with the next `window` ones.

    `batch` passes share a shuffle. The number of passes doubles, from `batch` on, until as many again as before join
    nothing more; so it follows the table's size and density. `sample` vectors, chosen by hash, place half of the planes. `chunk` bounds
    how many members of one component a task compares with as many others.
    """

    bits: int = 62
    window: int = 64
    batch: int = 16
    cosine: float = 0.9
    chunk: int = 2048
    sample: int = 4096
    seed: int = 7


def _norm(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each node's component under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not (new[new] == new).all():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _planes(number: int, dim: int, sample: np.ndarray, p: Passes) -> tuple[np.ndarray, np.ndarray]:
    """The directions and cuts of a pass. Every other plane goes through a random vector of the sample: a crowded region, in which most
    of the sample lies too, is cut by as many planes as it has its share of vectors; the others go through the middle."""
    rng = np.random.default_rng((p.seed, number))
    planes = rng.standard_normal((dim, p.bits))
    cuts = np.median(sample @ planes, axis=0)
    through = sample[rng.integers(0, len(sample), p.bits)]
    cuts[1::2] = (through * planes.T).sum(1)[1::2]
    return planes, cuts


def _pass_links(classes: DataFrame, sample: np.ndarray, first: int, p: Passes) -> DataFrame:
    """Spanning links (a, b) of the verified pairs in the windows of p.batch passes from `first` on.

    A worker streams its range of the order and carries the last `window` vectors on; a range's first vectors don't meet the end of the
    range before it, which other passes make up for.
    """
    spark = classes.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(sample)  # p.sample vectors
    kind = classes.schema["vec"].dataType.simpleString()

    def keyed(batches):
        planes = [_planes(first + k, shared.value.shape[1], shared.value, p) for k in range(p.batch)]
        weights = np.int64(1) << np.arange(p.bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            x = _norm(matrix(batch.column(1)))
            for k, (plane, cut) in enumerate(planes if len(x) else []):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k), pa.int64()), pa.array((x @ plane > cut) @ weights), *batch.columns], ["pass", "key", "node", "vec"])

    def compared(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            mine = (batch.column("pass").to_numpy(), batch.column("node").to_numpy(), _norm(matrix(batch.column("vec"))))
            before = len(held[0]) if held else 0
            which, node, x = (np.concatenate([h, m]) for h, m in zip(held, mine)) if held else mine
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i in range(0, len(x), 128):  # rows i to i + 128 with what follows them within the window
                s, t = np.nonzero(x[i : i + 128] @ x[i : i + 128 + p.window].T >= p.cosine)
                ok = (t > s) & (t - s <= p.window) & (i + t >= before) & (which[i + s] == which[np.minimum(i + t, len(x) - 1)])
                a.append(i + s[ok])
                b.append(i + t[ok])
            held = (which[-p.window :], node[-p.window :], x[-p.window :])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):  # the same vector may stand here for two passes: links are between nodes
                names, place = np.unique(node, return_inverse=True)
                root = _forest(len(names), place[a], place[b])
                moved = np.flatnonzero(root != np.arange(len(names)))
                yield pa.RecordBatch.from_arrays([pa.array(names[root[moved]], pa.int64()), pa.array(names[moved], pa.int64())], ["a", "b"])

    rows = classes.select("node", "vec").mapInArrow(keyed, f"pass long, key long, node long, vec {kind}")
    ordered = rows.repartitionByRange("pass", "key", "node").sortWithinPartitions("pass", "key", "node")
    return ordered.mapInArrow(compared, "a long, b long").distinct()


def _components(classes: DataFrame, p: Passes) -> DataFrame:
    """Rows (id, component) of the nodes that have links, after as many passes as it takes."""
    spark, n = classes.sparkSession, classes.count()
    share = min(1.0, p.sample / max(1, n))
    rows = classes.filter(F.pmod(F.xxhash64("node", F.lit(p.seed)), F.lit(1 << 30)) <= int(share * (1 << 30))).select("node", "vec").toArrow().sort_by("node")
    sample = _norm(matrix((rows if len(rows) else classes.select("node", "vec").limit(1).toArrow()).column("vec")))
    comps, done, step = spark.createDataFrame([], "id long, component long"), 0, p.batch
    while len(sample):
        grew = False
        for first in range(done, done + step, p.batch):
            found = written(_pass_links(classes, sample, first, p), "pass-links")
            of = lambda c: comps.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))  # noqa: B023, E731
            ends = found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
            fresh = ends.filter("a != b")
            if not fresh.isEmpty():
                grew = True
                comps = connected_components(fresh.unionByName(comps.select(F.col("component").alias("a"), F.col("id").alias("b"))))
            discard(found)
        done, step = done + step, done + step
        if not grew:
            break
    return comps


def _link_counts(members: DataFrame, p: Passes) -> DataFrame:
    """Rows (node, linked): how many vectors of other classes reach the threshold, counted over whole components.

    `members` (node, component, n, vec). A component is dealt to chunks by hash, and pairs of chunks are compared in blocks of their own; small
    components share a group. A block gives a row a member.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    total = members.count()
    several = F.ceil(F.col("size") / p.chunk)
    dealt = salted(members, sizes, ["component"]).withColumn("parts", several).withColumn("c", F.pmod(F.xxhash64("node"), "parts"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    bucket = F.when(F.col("parts") > 1, -1 - F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(max(1, total // 20_000))))
    dealt = dealt.select(bucket.alias("bucket"), F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "component", "node", "n", "vec")

    def compare(table):
        table = table.sort_by("component")
        x, n, c, node, comp = _norm(matrix(table.column("vec"))), *(table.column(k).to_numpy() for k in ("n", "c", "node", "component"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        linked = np.zeros(len(node), np.int64)
        start = np.flatnonzero(np.r_[True, comp[1:] != comp[:-1]])
        for s, e in zip(start, np.r_[start[1:], len(comp)]):
            left, right = s + np.flatnonzero(c[s:e] == i), s + np.flatnonzero(c[s:e] == j)
            for k in range(0, len(left), 1024):
                part = left[k : k + 1024]
                hit = x[part] @ x[right].T >= p.cosine
                if i == j:
                    hit[np.arange(len(part)), k + np.arange(len(part))] = False
                    linked[part] += hit @ n[right]
                else:
                    linked[part] += hit @ n[right]
                    linked[right] += hit.T @ n[part]
        return pa.table({"node": pa.array(node, pa.int64()), "linked": pa.array(linked, pa.int64())})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", p: Passes = Passes()) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for the rows of `df`.

    Equal vectors form a class, and classes are numbered. Passes sort the classes by random hashes and compare within windows, until as
    many passes again join nothing more. Links are then counted within whole components, in blocks, so none between members goes
    uncounted. Cosines are in double precision.

    Cases: vectors that are null, zero or hold null or non-finite components, and rows without id, link with nothing (component: the
    own id). All vectors must have one length. Every row is a vector of its own: rows that repeat an id with equal vectors are copies of each
    other, with different ones they have links and components each. Ties: a component is named by its smallest id. Other columns don't matter,
    whatever their names. An empty table gives no rows.
    """
    rows = written(usable(df, id_col, vec_col).withColumn("k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec")), "vectors")
    classes = rows.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    comps = _components(classes, p)
    members = written(classes.select("node", "n", "vec").join(comps.select(F.col("id").alias("node"), "component"), "node"), "vector-members")
    counts = _link_counts(members, p)
    state = classes.select("k1", "k2", "id", "n", "node").join(comps.select(F.col("id").alias("node"), "component"), "node", "left").join(counts, "node", "left")
    state = state.select("k1", "k2", "id", F.coalesce("component", "node").alias("c"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    state = written(state, "vector-state")
    names = state.groupBy("c").agg(F.min("id").alias("component_id"))
    state = salted(state.select("k1", "k2", "c", "n_links"), names, ["c"])
    own = salted(rows.select(F.col("id").alias("vec_id"), "k1", "k2"), state, ["k1", "k2"]).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    rest = unusable(df, id_col, vec_col).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    discard(members, classes)
    return own.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
