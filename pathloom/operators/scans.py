"""Scans that carry state from row to row, cut into chunks: what a chunk does to any state is summed up, states go from chunk to chunk
over the summaries, and the rows are gone through again, each chunk from its own state.

So a long group isn't one task: tasks hold `size` rows, and only the summaries of a group, a row a chunk, meet in one.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from ..storage import stored
from .numbering import numbered

#: Rows of a chunk.
SIZE = 100_000


def _chunked(df: DataFrame, by: list[str], order: list, size: int, ahead: int = 0) -> DataFrame:
    """Rows with _pos, _chunk and _own; the first `ahead` rows after a chunk's are copied to it, not its own."""
    rows = numbered(df, by, order, "_pos").withColumn("_home", F.expr(f"_pos div {size}"))
    if ahead:
        first = F.expr(f"greatest(_pos - {ahead}, 0L) div {size}")
        rows = rows.withColumn("_chunk", F.explode(F.sequence(first, F.col("_home"))))
    else:
        rows = rows.withColumn("_chunk", F.col("_home"))
    return rows.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")


def _scan(rows: DataFrame, by: list[str], summarise, summary: list[T.StructField], carry, state: T.StructField, go, out: T.StructType) -> DataFrame:
    """`summarise(chunk)` gives a chunk's summary as a dict, `carry(summaries)` the states before each from all of a group, in order, and
    `go(chunk, state)` a chunk's rows of the result."""
    ship(rows.sparkSession)
    keys = [rows.schema[c] for c in by]
    at = T.StructField("_chunk", T.LongType())
    chunks = stored(rows, "chunks")

    def one(chunk):
        found = summarise(chunk.sort_by("_pos"))
        out = chunk.slice(0, 1).select([*by, "_chunk"])
        for f in summary:
            out = out.append_column(f.name, pa.array([found[f.name]], _ARROW[f.dataType]))
        return out

    sums = chunks.groupBy(*by, "_chunk").applyInArrow(one, T.StructType([*keys, at, *summary]))

    def group(table):
        table = table.sort_by("_chunk")
        return table.select([*by, "_chunk"]).append_column(state.name, pa.array(carry(table.to_pylist()), _ARROW[state.dataType]))

    states = stored(sums.groupBy(*by).applyInArrow(group, T.StructType([*keys, at, state])), "states")

    def again(chunk, before):
        return go(chunk.sort_by("_pos"), before.column(state.name)[0].as_py())

    return chunks.groupBy(*by, "_chunk").cogroup(states.groupBy(*by, "_chunk")).applyInArrow(again, out)


_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.ArrayType(T.LongType()): pa.list_(pa.int64())}


def _numbers(column: pa.ChunkedArray, kind=float) -> np.ndarray:
    return column.to_numpy().astype(kind, copy=False)


def smooth_exponential(df: DataFrame, by: list[str], order: str, value: str, alpha: float = 0.5, size: int = SIZE) -> DataFrame:
    """(by, order, value, smoothed): s = alpha * value + (1 - alpha) * s before; the first value stands for itself. A null value leaves s
    as it is.

    A chunk of n values turns s into (1 - alpha) ** n * s plus a term of its own, which is its summary.
    """

    def values(chunk: pa.Table) -> list[float]:
        return _numbers(chunk.column(value)).tolist()

    def step(s, v):  # not a number: no value yet, or none here
        return s if v != v else v if s != s else alpha * v + (1 - alpha) * s

    def summarise(chunk: pa.Table) -> dict:
        v = values(chunk)
        *_, alone = accumulate(v, step, initial=math.nan)
        *_, term = accumulate(v, step, initial=0.0)
        return {"alone": alone, "share": (1 - alpha) ** sum(x == x for x in v), "term": term}

    def carry(chunks: list[dict]) -> list[float]:
        out, s = [], math.nan
        for c in chunks:
            out.append(s)
            s = c["alone"] if s != s else c["share"] * s + c["term"]
        return out

    def go(chunk: pa.Table, s: float) -> pa.Table:
        smoothed = list(accumulate(values(chunk), step, initial=s))[1:]
        return chunk.select([*by, order, value]).append_column("smoothed", pa.array(smoothed, pa.float64(), from_pandas=True))

    rows = _chunked(df.select(*by, order, F.col(value).cast("double").alias(value)), by, [order], size)
    double = T.DoubleType()
    out = T.StructType([*[rows.schema[c] for c in (*by, order)], T.StructField(value, double), T.StructField("smoothed", double)])
    summary = [T.StructField("alone", double), T.StructField("share", double), T.StructField("term", double)]
    return _scan(rows, by, summarise, summary, carry, T.StructField("s", double), go, out)


class Jumps:
    """A walk over rows of ascending `keys`: from a row on to the first whose key reaches the row's `target`."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray):
        self.keys, self.targets, n = keys, targets, len(keys)
        self.next = np.maximum(np.searchsorted(keys, targets), np.arange(1, n + 1))

    def summary(self) -> dict:
        """Where walks leave: those that enter at a key of at most upto[i], and above upto[i - 1], go on to exit[i]."""
        n = len(self.keys)
        last = np.where(self.next < n, np.minimum(self.next, n - 1), np.arange(n))
        while True:  # twice as far each time
            further = last[last]
            if (further == last).all():
                break
            last = further
        leave = self.targets[last]
        ends = np.flatnonzero(np.r_[leave[1:] != leave[:-1], True])
        return {"upto": self.keys[ends].tolist(), "exit": leave[ends].tolist()}

    def visited(self, entry: int | None) -> np.ndarray:
        out, i = [], 0 if entry is None else int(np.searchsorted(self.keys, entry))
        while i < len(self.keys):
            out.append(i)
            i = int(self.next[i])
        return np.array(out, int)


_JUMPS = [T.StructField("upto", T.ArrayType(T.LongType())), T.StructField("exit", T.ArrayType(T.LongType()))]


def _carry_jumps(chunks: list[dict]) -> list[int | None]:
    out, key = [], None
    for c in chunks:
        out.append(key)
        if key is None or key <= c["upto"][-1]:
            key = c["exit"][0 if key is None else int(np.searchsorted(c["upto"], key))]
    return out


def cooldown(df: DataFrame, by: list[str], at: str, wait: int, size: int = SIZE) -> DataFrame:
    """Keeps a row only if it is `wait` or more after the last one kept: (by, at). Of rows at one time one stays at most, unless `wait` is 0
    or less; rows without a time go."""

    def jumps(chunk: pa.Table) -> Jumps:
        t = _numbers(chunk.column(at), np.int64)
        return Jumps(t, t + wait)

    def go(chunk: pa.Table, entry: int | None) -> pa.Table:
        return chunk.select([*by, at]).take(pa.array(jumps(chunk).visited(entry)))

    rows = df.select(*by, F.col(at).cast("long").alias(at)).filter(F.col(at).isNotNull())
    if wait <= 0:
        return rows
    return _scan(_chunked(rows, by, [at], size), by, lambda c: jumps(c).summary(), _JUMPS, _carry_jumps, T.StructField("entry", T.LongType()), go, rows.schema)


def stays(df: DataFrame, by: list[str], order: str, x: str, y: str, owner: str, reach: float, least: int, size: int = SIZE) -> DataFrame:
    """(by, owner, start, end): times in which (x, y) keeps within `reach` of where it was with the same owner, for `least` rows in succession.

    A row begins anew where it is too far from the row that the present stay began with, where the owner is another, and after a stay that
    was long enough; rows without owner begin nothing. A stay is known `least` rows after its first one at the latest, so a chunk with
    that many rows of the next one knows where each of its rows leads.
    """
    most = max(1, least - 1)

    def jumps(chunk: pa.Table) -> tuple[Jumps, np.ndarray, np.ndarray]:
        own = int(np.count_nonzero(_numbers(chunk.column("_own"), bool)))
        pos, px, py = _numbers(chunk.column("_pos"), np.int64), _numbers(chunk.column(x)), _numbers(chunk.column(y))
        who = pc.fill_null(chunk.column(owner).combine_chunks().dictionary_encode().indices, -1).to_numpy()
        target, fires = pos[:own] + 1, np.zeros(own, bool)
        here = np.flatnonzero(who[:own] >= 0)
        for d in range(1, most + 1):
            here = here[here + d < len(pos)]
            there = here + d
            target[here] = pos[there]
            near = (np.sqrt((px[there] - px[here]) ** 2 + (py[there] - py[here]) ** 2) <= reach) & (who[there] == who[here])
            here = here[near]
            target[here] = pos[here + d] + 1
        fires[here] = True
        return Jumps(pos[:own], target), fires, np.arange(own) + most

    def go(chunk: pa.Table, entry: int | None) -> pa.Table:
        walk, fires, ends = jumps(chunk)
        at = walk.visited(entry)
        at = at[fires[at]]
        start, end = chunk.take(pa.array(at)), chunk.take(pa.array(ends[at]))
        return start.select([*by, owner]).append_column("start", start.column(order)).append_column("end", end.column(order))

    columns = df.select(*by, order, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y), owner)
    rows = _chunked(columns, by, [order], size, most)
    kind = rows.schema[order].dataType
    out = T.StructType([*[rows.schema[c] for c in (*by, owner)], T.StructField("start", kind), T.StructField("end", kind)])
    return _scan(rows, by, lambda c: jumps(c)[0].summary(), _JUMPS, _carry_jumps, T.StructField("entry", T.LongType()), go, out)
