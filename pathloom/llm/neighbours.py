"""Approximate nearest neighbours by a forest of random-projection trees with one priority queue for all trees."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discard, written
from .vectors import matrix, usable


@dataclass(frozen=True)
class Forest:
    """Parameters. The trees are fitted on at most `sample` vectors, chosen by hash; every vector is indexed.

    The depth follows the number of vectors: leaves hold about `leaf` of them, until 2 ** `depth` leaves are reached. The number of
    leaves searched is fitted too: the least that finds `recall` of the sample's own neighbours; a query goes on until the leaves of
    one tree hold about `least` vectors. `chunk` bounds the vectors that a task holds. `spread` is how far neighbours stray from a query along a plane, as a share of the greatest norm.
    """

    trees: int = 12
    leaf: int = 16
    depth: int = 13
    sample: int = 32_768
    recall: float = 0.93
    least: int = 512
    chunk: int = 16_384
    spread: float = 0.4
    seed: int = 11

    def at(self, rows: int) -> Forest:
        """These parameters with the depth for so many rows."""
        most = max(0, min(rows, self.sample) // 4).bit_length() - 1
        return replace(self, depth=max(0, min(self.depth, most, (-(-rows // self.leaf) - 1).bit_length())))


class Index:
    """The fitted forest: plain arrays, of a size that the parameters bound. `home` gives the leaves of the sample's own vectors."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, p: Forest):
        self.p, self.leaves, self.ids, self.sample = p, 1 << p.depth, ids, sample
        rng = np.random.default_rng(p.seed)
        self.reach = float(np.sqrt((sample * sample).sum(1)).max()) if len(sample) else 1.0
        x = self.lift(sample)
        nodes = self.leaves - 1
        self.planes, self.cuts = np.zeros((p.trees, nodes, x.shape[1]), np.float32), np.zeros((p.trees, nodes), np.float32)
        for t in range(p.trees):
            self._split(t, 0, x, np.arange(len(x)), rng)
        self.home = self.leaf_of(sample)  # by the same arithmetic as every stored vector
        self.held = np.array([np.bincount(self.home[:, t], minlength=self.leaves) for t in range(p.trees)])

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Stored vectors with one more component that gives all the same norm, so that large inner product means near."""
        rest = np.maximum(self.reach**2 - (x * x).sum(1), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]]).astype(np.float32)

    def _split(self, t: int, node: int, x: np.ndarray, rows: np.ndarray, rng) -> None:
        if node >= self.planes.shape[1]:
            return
        plane = rng.standard_normal(x.shape[1])
        if len(rows) > 1:  # the gap between two random members, as is usual for such trees
            a, b = rng.integers(0, len(rows), 2)
            gap = (x[rows[a]] - x[rows[b]]).astype(float)
            plane = gap if gap @ gap > 1e-9 else plane
        self.planes[t, node] = plane / np.sqrt(plane @ plane)
        side = x[rows] @ self.planes[t, node]
        self.cuts[t, node] = np.median(side) if len(rows) else 0.0
        right = side > self.cuts[t, node]
        self._split(t, 2 * node + 1, x, rows[~right], rng)
        self._split(t, 2 * node + 2, x, rows[right], rng)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each stored vector in each tree."""
        x = self.lift(x)
        out = np.empty((len(x), self.p.trees), np.int64)
        for t in range(self.p.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.p.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.planes[t, node]) > self.cuts[t, node])
            out[:, t] = node - (self.leaves - 1)
        return out

    def steps(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What it costs queries to go left or right at each node (query, tree, node): how unlikely a neighbour is to lie there, as a
        negative logarithm."""
        norm = np.sqrt((q * q).sum(1, keepdims=True))
        q = np.hstack([q * (self.reach / np.maximum(norm, 1e-300)), np.zeros((len(q), 1))]).astype(np.float32)
        z = (q @ self.planes.reshape(-1, q.shape[1]).T).reshape(len(q), *self.cuts.shape)
        z = (z - self.cuts) * np.float32(1.702 / (self.p.spread * self.reach))  # the logistic stand-in for the normal distribution
        even = np.log1p(np.exp(-np.abs(z)))
        return even + np.maximum(z, 0), even + np.maximum(-z, 0)

    def queued(self, q: np.ndarray, budget: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs for a query: one queue for all trees, cheapest way first, `budget` leaves of it."""
        left, right = (s[0] for s in self.steps(q[None, :]))
        queue = [(0.0, t, 0) for t in range(self.p.trees)]
        found, inner = [], self.planes.shape[1]
        while queue and len(found) < budget:
            cost, t, node = heapq.heappop(queue)
            if node >= inner:
                found.append((t, node - inner))
                continue
            heapq.heappush(queue, (cost + left[t, node], t, 2 * node + 1))
            heapq.heappush(queue, (cost + right[t, node], t, 2 * node + 2))
        return found

    def costs(self, q: np.ndarray) -> np.ndarray:
        """What each leaf of each tree costs each query. The queue gives leaves in the order of these sums, for no step is negative."""
        left, right = self.steps(q)
        cost, at = np.zeros((len(q), self.p.trees, 1), np.float32), 0
        for level in range(self.p.depth):
            n = 1 << level
            cost = np.stack([cost + left[:, :, at : at + n], cost + right[:, :, at : at + n]], 3).reshape(len(q), self.p.trees, 2 * n)
            at += n
        return cost

    def chosen(self, cost: np.ndarray, budget: int, least: int) -> np.ndarray:
        """Which leaves the queue gives first, as a mask (tree, leaf): `budget` of them, and more until some tree's hold `least` of the sample."""
        cost = cost.ravel()
        while True:
            mask = np.zeros(cost.shape, bool)
            mask[np.argpartition(cost, budget - 1)[:budget] if budget < len(cost) else slice(None)] = True
            mask = mask.reshape(self.held.shape)
            if budget >= len(cost) or (self.held * mask).sum(1).max() >= least:
                return mask
            budget *= 2

    def bar(self, query_id: int, scores: np.ndarray, mask: np.ndarray, k: int) -> float:
        """A score that k others reach for certain: the k-th best of the sampled vectors that lie in the chosen leaves."""
        trees = np.arange(self.p.trees)[None, :]
        for most in (8 * k, len(scores)):
            best = np.argpartition(-scores, most - 1)[:most] if most < len(scores) else np.arange(len(scores))
            best = best[(self.ids[best] != query_id) & mask[trees, self.home[best]].any(1)]
            best = best[np.unique(self.ids[best], return_index=True)[1]]  # repeated ids count once
            if len(best) >= k:
                return float(np.partition(scores[best], -k)[-k]) - 1e-9
        return -np.inf


def fit(vectors: DataFrame, p: Forest, k: int) -> tuple[Index, int, int]:
    """The index, the number of leaves to search and that of vectors, from about p.sample rows at most."""
    n = vectors.count()
    share = min(1.0, p.sample / max(1, n))
    picked = vectors if share == 1.0 else vectors.filter(F.pmod(F.xxhash64("id", F.lit(p.seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = picked.toArrow().sort_by("id")
    x = matrix(rows.column("vec"))
    p = p.at(n)
    index = Index(rows.column("id").to_numpy(), x, p)
    every = p.trees * index.leaves
    k = min(k, len(x) - 1)
    if k < 1 or not p.depth:
        return index, every, n
    met = []
    for i in np.random.default_rng(p.seed).choice(len(x), min(len(x), 100), replace=False):
        score = x @ x[i]
        score[i] = -np.inf
        near = np.argpartition(-score, k - 1)[:k]
        cost = index.costs(x[i : i + 1])[0]
        # the place in the queue at which each true neighbour is met first
        first = cost[np.arange(p.trees)[None, :], index.home[near]].min(1)
        met.append(np.searchsorted(np.sort(cost.ravel()), first, "right"))
    return index, int(np.quantile(np.concatenate(met), p.recall, method="higher")), n


def _once(m: np.ndarray, n: np.ndarray, s: np.ndarray, ids: np.ndarray) -> tuple:
    """Of rows (query, place, score) the best of each query and id."""
    order = np.lexsort((-s, ids[n], m))
    m, n, s = m[order], n[order], s[order]
    first = np.r_[True, (m[1:] != m[:-1]) | (ids[n][1:] != ids[n][:-1])] if len(m) else np.empty(0, bool)
    return m[first], n[first], s[first]


def best_in_leaves(ids: np.ndarray, leaf: np.ndarray, x: np.ndarray, q: np.ndarray, v: np.ndarray, mask: np.ndarray, bar: np.ndarray, k: int, held: int = 1 << 20):
    """The k best (query, id, score) of each query, of what reaches its `bar`, in the leaves that its row of `mask` names; ties go to the smaller id.

    Of equal vectors only the k + 1 smallest ids can be among them, so a crowd of copies isn't scored. What is found so far is cut to the best k of
    each query whenever it exceeds `held`, and their least score is the bar for what follows.
    """
    order = np.argsort(ids, kind="stable")
    same = np.unique(np.ascontiguousarray(x[order]).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel(), return_inverse=True)[1] if len(x) else order
    by = np.argsort(same, kind="stable")
    by = by[np.r_[True, (same[by][1:] != same[by][:-1]) | (ids[order[by]][1:] != ids[order[by]][:-1])]] if len(by) else by  # an id with one vector twice
    start = np.flatnonzero(np.r_[True, same[by][1:] != same[by][:-1]]) if len(by) else by
    rank = np.arange(len(by)) - np.repeat(start, np.diff(np.r_[start, len(by)]))
    keep = np.sort(order[by[rank <= k]])
    ids, leaf, x = ids[keep], leaf[keep], x[keep]
    bar = bar.copy()
    found: list[tuple] = []

    def cut():
        m, n, s = (np.concatenate(c) for c in zip(*found))
        other = q[m] != ids[n]
        m, n, s = m[other], n[other], s[other]
        m, n, s = _once(m, n, s, ids)
        order = np.lexsort((-s, m))
        m, n, s = m[order], n[order], s[order]
        start = np.flatnonzero(np.r_[True, m[1:] != m[:-1]]) if len(m) else np.empty(0, np.int64)
        size = np.diff(np.r_[start, len(m)])
        kth = np.where(size >= k, s[np.minimum(start + k, len(s)) - 1], -np.inf)
        bar[m[start]] = np.maximum(bar[m[start]], kth - 1e-9)
        ok = s >= bar[m]
        found[:] = [(m[ok], n[ok], s[ok])]

    at = np.argsort(leaf, kind="stable")
    x, ids, leaf = x[at], ids[at], leaf[at]
    start = np.searchsorted(leaf, np.arange(mask.shape[1] + 1))
    total = 0
    for number in np.flatnonzero(np.diff(start)):
        here, ask = x[start[number] : start[number + 1]].T, np.flatnonzero(mask[:, number])
        for i in range(0, len(ask), 4096):
            rows = ask[i : i + 4096]
            s = v[rows] @ here
            m, n = np.nonzero(s >= bar[rows, None])
            if len(m):
                found.append((rows[m], start[number] + n, s[m, n]))
                total += len(m)
                if total > held:
                    cut()
                    total = len(found[0][0])
                    held = max(held, 2 * total)
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    cut()
    m, n, _ = found[0]
    # one formula everywhere, so that equal vectors have equal scores
    s = np.concatenate([np.empty(0), *[(v[m[i : i + 65536]] * x[n[i : i + 65536]]).sum(1) for i in range(0, len(m), 65536)]])
    m, n, s = _once(m, n, s, ids)
    order = np.lexsort((ids[n], -s, m))
    m, n, s = m[order], n[order], s[order]
    start = np.flatnonzero(np.r_[True, m[1:] != m[:-1]]) if len(m) else np.empty(0, np.int64)
    ok = np.arange(len(m)) - np.repeat(start, np.diff(np.r_[start, len(m)])) < k
    return q[m[ok]], ids[n[ok]], s[ok]


def nearest(df: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", p: Forest = Forest()) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for the vectors whose id is divisible by `every`, the `k` others of largest inner product.

    Every result comes from a searched leaf, scored exactly, in double precision, subtree by subtree; a subtree gives a query its k best.
    The sampled vectors that lie in a query's leaves, k of them at least, only set a bar below which nothing is sent on. Ties go to the
    smaller id.

    Cases: vectors that are null, zero or hold null or non-finite components, and rows without id, take no part. All must have one
    length. Repeated ids are scored each, and the best counts; a query never finds its own id. Of fewer than k
    candidates all are returned. An empty table gives no rows. Subtrees that hold more than `p.chunk` vectors are cut into chunks
    by hash. Other columns don't matter, whatever their names.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    vectors = written(usable(df, id_col, vec_col), "ann-vectors")
    index, budget, n = fit(vectors, p, k)
    if not n:
        return spark.createDataFrame([], schema)
    p, sampled = index.p, len(index.ids)
    least = min(sampled, max(k + 1, p.least * sampled // n))
    top = min(p.depth, max(0, (-(-n // p.chunk) - 1).bit_length()))
    groups, inside = 1 << top, 1 << (p.depth - top)
    # salts for subtrees that the sample says to hold more than a task should: trees * groups numbers
    crowd = index.held.reshape(p.trees * groups, inside).sum(1) * (n / sampled)
    parts = np.maximum(1, np.ceil(crowd / p.chunk)).astype(int)
    shared = spark.sparkContext.broadcast((index, parts))  # bounded by p.depth and p.trees
    vec_type = vectors.schema["vec"].dataType

    def store(batches):
        index, parts = shared.value
        for batch in batches:
            leaf = index.leaf_of(matrix(batch.column(1))) if len(batch) else np.empty((0, p.trees), np.int64)
            salt = batch.column(0).to_numpy() * 0x9E3779B1 >> 7
            for t in range(p.trees):
                grp = t * groups + leaf[:, t] // inside
                yield pa.RecordBatch.from_arrays([pa.array(grp), pa.array(salt % parts[grp]), pa.array(leaf[:, t] % inside), *batch.columns], ["grp", "salt", "leaf", "id", "vec"])

    def ask(batches):
        index, parts = shared.value
        for batch in batches:
            out = [[], [], [], [], []]
            x, ids = matrix(batch.column(1)), batch.column(0).to_pylist()
            for b in range(0, len(x), 32):
                part = x[b : b + 32]
                scores = part @ index.sample.T
                for i, cost in enumerate(index.costs(part)):
                    mask = index.chosen(cost, budget, least)
                    bar = index.bar(ids[b + i], scores[i], mask, k)
                    mask = mask.reshape(p.trees * groups, inside)
                    for g in np.flatnonzero(mask.any(1)).tolist():
                        bits = np.packbits(mask[g]).tobytes()
                        for s in range(parts[g]):
                            for column, value in zip(out, (g, s, bits, bar, b + i)):
                                column.append(value)
            rows = pa.array(out[4], pa.int64())
            columns = [pa.array(c, t) for c, t in zip(out[:4], (pa.int64(), pa.int64(), pa.binary(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(rows), batch.column(1).take(rows)], ["grp", "salt", "mask", "bar", "query_id", "vec"])

    def score(stored, asked):
        out = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if len(stored) and len(asked):
            mask = np.unpackbits(np.array([np.frombuffer(m, np.uint8) for m in asked.column("mask").to_pylist()]), axis=1)[:, :inside].astype(bool)
            ours = (stored.column("id").to_numpy(), stored.column("leaf").to_numpy(), matrix(stored.column("vec")))
            out = best_in_leaves(*ours, asked.column("query_id").to_numpy(), matrix(asked.column("vec")), mask, asked.column("bar").to_numpy(), k)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    kind = vec_type.simpleString()
    stored = vectors.mapInArrow(store, f"grp long, salt long, leaf long, id long, vec {kind}")
    asked = vectors.filter(F.col("id") % every == 0).mapInArrow(ask, f"grp long, salt long, mask binary, bar double, query_id long, vec {kind}")
    found = stored.groupBy("grp", "salt").cogroup(asked.groupBy("grp", "salt")).applyInArrow(score, "query_id long, vec_id long, score double")
    every_one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = written(every_one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ann-found")
    discard(vectors)
    return out
