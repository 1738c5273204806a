"""Exact top-k search by inner product: tiles of queries and shards, a partial selection in each, a tree that merges the lists."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, shuffle_partitions, written
from .toplists import TOP, merged, to_lists

_MOST = (1 << 63) - 1


@dataclass(frozen=True)
class Tiles:
    """A cell is a group of at most about `group` queries and a shard of at most about `shard` candidates, dealt by hash of their ids; a
    group's vectors take `megabytes` at most. Within a cell, products are taken `tile` candidates and `block` queries at a time. Small
    tables get smaller shards, so that there are about `cells` of them."""

    group: int = 16_384
    shard: int = 65_536
    megabytes: int = 64
    tile: int = 4096
    block: int = 1024
    cells: int = 24


def quantised(vec: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component x as double; beyond a long's range, the range's end."""
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def whole(vec: Column) -> Column:
    """Whether a vector is not null and holds neither null nor non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vec.cast("array<double>"), fine), F.lit(False))


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exactly: in floating point where no sum can leave its whole numbers, else in integers. What leaves
    a long's range becomes the range's end."""
    bound = q.shape[1] * _largest(q) * _largest(c)
    for limit, kind in ((1 << 24, np.float32), (1 << 53, np.float64), (1 << 63, np.int64)):
        if bound < limit:
            return q.astype(kind) @ c.astype(kind).T
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, -_MOST, _MOST).astype(np.int64)


def selected(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the `k` largest scores of each row, largest first, ties to the smaller column."""
    rows, n = scores.shape
    k = min(k, n)
    if scores.dtype != np.int64 and _largest(scores) < (1 << 52) // n:
        keys = np.arange(n, dtype=np.float64) - scores.astype(np.float64) * n  # smallest first; no two of a row are equal
        best = np.argpartition(keys, k - 1, axis=1)[:, :k] if k < n else np.broadcast_to(np.arange(n), scores.shape)
        return np.take_along_axis(best, np.argsort(np.take_along_axis(keys, best, 1), axis=1), 1)
    return np.argsort(~scores.astype(np.int64), axis=1, kind="stable")[:, :k]


class _Cell:
    """The queries of a cell and their best candidates so far. Queries come first, then candidates by ascending id."""

    def __init__(self, key: tuple, k: int, p: Tiles):
        self.key, self.k, self.p = key, k, p
        self.queries, self.waiting, self.rows = [], [], 0
        self.best = None

    def add(self, side: int, ids: np.ndarray, x: np.ndarray) -> None:
        if side == 0:
            self.queries.append((ids, x))
            return
        self.waiting.append((ids, x))
        self.rows += len(ids)
        if self.rows >= self.p.tile:
            self.run()

    def run(self) -> None:
        if not self.queries or not self.waiting:
            self.waiting, self.rows = [], 0
            return
        if self.best is None:
            self.ids, self.x = (np.concatenate(c) for c in zip(*self.queries))
            pad = (len(self.ids), self.k)
            self.best = np.full(pad, -_MOST - 1), np.zeros(pad, np.int64)
        ids, x = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.rows = [], 0
        for a in range(0, len(self.ids), self.p.block):
            at = slice(a, a + self.p.block)
            s = products(self.x[at], x)
            top = selected(s, self.k + 1)  # one more, for the query's own row may be among them
            s, found = np.take_along_axis(s, top, 1).astype(np.int64), ids[top]
            s[found == self.ids[at, None]] = -_MOST - 1
            # held ids are smaller than new ones, so that a stable order settles ties
            s, found = np.hstack([self.best[0][at], s]), np.hstack([self.best[1][at], found])
            order = np.argsort(~s, axis=1, kind="stable")[:, : self.k]
            self.best[0][at], self.best[1][at] = np.take_along_axis(s, order, 1), np.take_along_axis(found, order, 1)

    def finish(self):
        self.run()
        if self.best is not None:
            scores, ids = self.best
            there = scores > -_MOST - 1
            lists = to_lists(there.sum(1), scores[there], ids[there])
            part = pa.array(np.full(len(self.ids), self.key[2]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(self.ids, pa.int64()), part, lists], ["query_id", "part", "top"])
        self.queries, self.best = [], None


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding", p: Tiles = Tiles()) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for the rows that `is_query` (over a column `id`) holds for, the `k` other rows of largest
    inner product of the quantised vectors, all rows compared, ties to the smaller id.

    Every pair of a query and a candidate is multiplied, in cells that the whole cluster shares. A cell holds a group of queries and
    streams its candidates, so memory doesn't depend on the table; a query has one list a shard, merged in a tree.

    Cases: vectors that are null or hold null or non-finite components, and rows without id, take no part; a zero or empty vector does. Only
    vectors of one length are compared. Of rows that repeat an id the greatest vector, in the order of arrays, counts. Components beyond
    a long's range, and scores beyond it, are the range's end. An empty table gives no rows. Other columns don't matter, whatever
    their names.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(F.col("id").isNotNull() & whole(F.col("vec")))
    vectors = written(kept.select("id", quantised(F.col("vec"), scale).alias("vec")).groupBy("id").agg(F.max("vec").alias("vec")), "topk-vectors")
    asks = F.coalesce(is_query, F.lit(False))
    n, asked, width = vectors.agg(F.count("*"), F.count_if(asks), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = -(-n // max(2048, min(p.shard, -(-n // p.cells))))
    groups = -(-asked // max(256, min(p.group, (p.megabytes << 20) // (8 * max(1, width)))))

    dim = F.size("vec").alias("dim")
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    one = lambda m, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(m))
    left = vectors.filter(asks).select(dim, one(groups, 1).alias("g"), every(shards).alias("s"), F.lit(0).alias("side"), "id", "vec")
    right = vectors.select(dim, every(groups).alias("g"), one(shards, 2).alias("s"), F.lit(1).alias("side"), "id", "vec")
    parts = min(2 * shards * groups, 16 * shuffle_partitions(spark))
    cells = left.unionByName(right).repartition(parts, "dim", "g", "s").sortWithinPartitions("dim", "g", "s", "side", "id")

    def work(batches):
        cell = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if a == b:
                    continue
                *key, side = keys[:, a].tolist()
                if cell is None or cell.key != tuple(key):
                    if cell is not None:
                        yield from cell.finish()
                    cell = _Cell(tuple(key), k, p)
                rows = batch.slice(a, b - a)
                flat = rows.column("vec").flatten().to_numpy()
                cell.add(side, rows.column("id").to_numpy(), flat.reshape(b - a, key[0]))
        if cell is not None:
            yield from cell.finish()

    lists = written(cells.mapInArrow(work, f"query_id long, part long, top {TOP}"), "topk-lists")
    discard(vectors)
    return merged(lists, "query_id", shards, k).withColumnRenamed("id", "vec_id")
