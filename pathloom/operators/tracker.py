"""Tracks from detections, frame by frame: two-threshold association with a constant-velocity filter, after the published ByteTrack
method; the choice of one ball by its recent places; ring buffers of frames about a trigger.

The same state machines serve tables (a group at a time, memory bounded by what is alive) and streams (streaming.tracks).
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from ..storage import stored
from . import joins
from .graphs import components
from .numbering import numbered

BOX = ["x1", "y1", "x2", "y2"]
#: Pairs of tracks and boxes whose costs are held at once; of more, a track's costs are made whenever they are looked at.
DENSE = 1_000_000


@dataclass(frozen=True)
class Association:
    """Boxes of `high` confidence and more meet tracks first, those of `low` and more the tracks that are left. A pair needs an overlap of
    1 - `far` (the second time 0.5, for fresh tracks 0.3). A lost track is kept for `buffer` frames."""

    high: float = 0.25
    low: float = 0.1
    start: float = 0.35
    far: float = 0.8
    buffer: int = 60


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every box of `a` with every one of `b`."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.clip(high - low, 0, None).prod(2)
    size = lambda x: (x[:, 2:] - x[:, :2]).prod(1)
    return both / np.maximum(size(a)[:, None] + size(b)[None, :] - both, 1e-9)


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairs (row, column) of least total cost, by shortest augmenting paths; every row of the shorter side gets a partner."""
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assignment(cost.T))
    return _assigned(cost.__getitem__, *cost.shape)


def close_pairs(a: np.ndarray, b: np.ndarray, far: float) -> list[tuple[int, int]]:
    """assignment() of boxes `a` and `b` by 1 - overlap, costs above `far` being alike; pairs above it are left out."""
    turned = len(a) > len(b)
    rows, columns = (b, a) if turned else (a, b)
    row = lambda i: 1 - overlaps(rows[i : i + 1], columns)[0]
    if len(a) * len(b) <= DENSE:
        row = (1 - overlaps(rows, columns)).__getitem__
    pairs = _assigned(lambda i: np.minimum(row(i), far + 1e-3), len(rows), len(columns)) if len(rows) else []
    return sorted((c, r) if turned else (r, c) for r, c in pairs if row(r)[c] <= far)


def _assigned(row_of, n: int, m: int) -> list[tuple[int, int]]:
    """assignment() of n rows, no more than the m columns, whose costs `row_of` gives."""
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j, way = i, 0, np.zeros(m + 1, int)
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while match[j]:
            used[j] = True
            row = row_of(match[j] - 1) - u[match[j]] - v[1:]
            better = ~used[1:] & (row < least[1:])
            least[1:][better], way[1:][better] = row[better], j
            free = np.where(used, np.inf, least)
            free[0] = np.inf
            nxt = int(free.argmin())
            delta = free[nxt]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j = nxt
        while j:
            match[j], j = match[way[j]], way[j]
    return sorted((int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j])


class _Track:
    """A box's centre, aspect and height with their velocities; noise grows with the height."""

    def __init__(self, number: int, box: np.ndarray, frame: int):
        z = self._measure(box)
        self.id, self.seen, self.hits = number, frame, 1
        self.mean = np.r_[z, np.zeros(4)]
        h = z[3]
        self.cov = np.diag(np.array([2 * h / 20, 2 * h / 20, 1e-2, 2 * h / 20, h / 16, h / 16, 1e-5, h / 16]) ** 2)

    @staticmethod
    def _measure(box: np.ndarray) -> np.ndarray:
        w, h = box[2] - box[0], box[3] - box[1]
        return np.array([(box[0] + box[2]) / 2, (box[1] + box[3]) / 2, w / max(h, 1e-9), h])

    def predict(self) -> None:
        step = np.eye(8)
        step[:4, 4:] = np.eye(4)
        h = self.mean[3]
        noise = np.array([h / 20, h / 20, 1e-2, h / 20, h / 160, h / 160, 1e-5, h / 160]) ** 2
        self.mean = step @ self.mean
        self.cov = step @ self.cov @ step.T + np.diag(noise)

    def update(self, box: np.ndarray, frame: int) -> None:
        h = self.mean[3]
        s = self.cov[:4, :4] + np.diag(np.array([h / 20, h / 20, 1e-1, h / 20]) ** 2)
        gain = np.linalg.solve(s, self.cov[:4]).T
        self.mean = self.mean + gain @ (self._measure(box) - self.mean[:4])
        self.cov = self.cov - gain @ s @ gain.T
        self.seen, self.hits = frame, self.hits + 1

    def box(self) -> np.ndarray:
        x, y, a, h = self.mean[:4]
        return np.array([x - a * h / 2, y - h / 2, x + a * h / 2, y + h / 2])

    def packed(self) -> tuple[int, int, list[float], list[float]]:
        """(seen, hits, mean, cov) as plain values."""
        return self.seen, self.hits, self.mean.tolist(), self.cov.ravel().tolist()

    @classmethod
    def unpacked(cls, number: int, seen: int, hits: int, mean, cov) -> _Track:
        out = cls.__new__(cls)
        out.id, out.seen, out.hits, out.mean, out.cov = number, seen, hits, np.array(mean, float), np.array(cov, float).reshape(8, 8)
        return out


class Tracker:
    """Gives boxes of successive frames the numbers of their tracks."""

    def __init__(self, p: Association = Association()):
        self.p, self.tracks, self.next, self.first = p, [], 1, None

    def update(self, frame: int, boxes: np.ndarray, conf: np.ndarray) -> np.ndarray:
        """The track of each box, -1 for none. Frames ascend; state of an earlier file must not be carried over."""
        p, out = self.p, np.full(len(boxes), -1)
        self.first = frame if self.first is None else self.first
        self.tracks = [t for t in self.tracks if frame - t.seen <= p.buffer]
        for t in self.tracks:
            t.predict()
        firm = [t for t in self.tracks if t.hits > 1 or t.seen == self.first]
        fresh = [t for t in self.tracks if not (t.hits > 1 or t.seen == self.first)]

        def meet(tracks: list, which: np.ndarray, far: float) -> tuple[list, np.ndarray]:
            if not tracks or not len(which):
                return tracks, which
            pairs = close_pairs(np.array([t.box() for t in tracks]), boxes[which], far)
            for r, c in pairs:
                tracks[r].update(boxes[which[c]], frame)
                out[which[c]] = tracks[r].id
            rows, columns = {r for r, _ in pairs}, {c for _, c in pairs}
            return [t for r, t in enumerate(tracks) if r not in rows], np.array([w for c, w in enumerate(which) if c not in columns], int)

        left, high = meet(firm, np.flatnonzero(conf >= p.high), p.far)
        meet([t for t in left if frame - t.seen == 1], np.flatnonzero((conf >= p.low) & (conf < p.high)), 0.5)
        gone, high = meet(fresh, high, 0.7)
        self.tracks = [t for t in self.tracks if t not in gone]  # a fresh track that isn't met again at once goes
        for i in high:
            if conf[i] >= p.start:
                self.tracks.append(_Track(self.next, boxes[i], frame))
                out[i] = self.next
                self.next += 1
        return out


def track(detections: DataFrame, by: list[str], frame: str = "frame", conf: str = "conf", p: Association = Association(), chunk: int | None = None) -> DataFrame:
    """Adds `track` to boxes (by, frame, x1, y1, x2, y2, conf): numbers from 1 within each group, such as file and class, null for boxes
    that belong to none. Rows of a frame go by confidence, then place, so the result doesn't depend on their order.

    With `chunk` a group is cut into that many frames a task, see track_in_chunks(). Without, a group is a task, and runs in order throughout.
    """
    if chunk is not None:
        return track_in_chunks(detections, by, frame, conf, p, chunk)
    ship(detections.sparkSession)
    schema = T.StructType([*detections.schema.fields, T.StructField("track", T.LongType())])
    return detections.groupBy(*by).applyInPandas(lambda g: _tracked(g, frame, conf, p), schema)


def _tracked(g: pd.DataFrame, frame: str, conf: str, p: Association) -> pd.DataFrame:
    g = g.sort_values([frame, conf, *BOX], ascending=[True, False, True, True, True, True], kind="stable").reset_index(drop=True)
    tracker, out = Tracker(p), np.full(len(g), -1)
    boxes, c, f = g[BOX].to_numpy(float), g[conf].to_numpy(float), g[frame].to_numpy()
    edges = np.flatnonzero(np.r_[True, f[1:] != f[:-1], True]) if len(f) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        out[a:b] = tracker.update(int(f[a]), boxes[a:b], c[a:b])
    return g.assign(track=pd.array([None if t < 0 else int(t) for t in out], dtype="Int64"))


def _streamed(keys: list[str], frame: str, conf: str, p: Association, home: str | None = None):
    """For mapInArrow: adds `track` to rows sorted by keys, frame, falling confidence and place, and drops those of none. A task holds a batch
    of rows or a frame, and the tracks alive. The last key is a chunk: with `home`, one that has no rows of its own first is left out."""

    def codes(column: pa.ChunkedArray) -> np.ndarray:
        return pc.fill_null(column.combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)

    def work(batches):
        waiting, tracker, goes_on = None, None, False

        def done(table: pa.Table, edges: np.ndarray, new: np.ndarray) -> list[pa.RecordBatch]:
            nonlocal tracker
            boxes = np.stack([table.column(c).cast(pa.float64()).to_numpy() for c in BOX], 1)
            c, f = table.column(conf).cast(pa.float64()).to_numpy(), table.column(frame).to_numpy()
            own = np.ones(len(table), bool) if home is None else table.column(home).to_numpy() == table.column(keys[-1]).to_numpy()
            out = np.full(len(table), -1)
            for a, b, fresh in zip(edges[:-1], edges[1:], new):
                if fresh:
                    tracker = Tracker(p) if own[a] else None
                if tracker is not None:
                    out[a:b] = tracker.update(int(f[a]), boxes[a:b], c[a:b])
            return table.append_column("track", pa.array(out, pa.int64())).filter(pa.array(out >= 0)).combine_chunks().to_batches()

        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table]).combine_chunks()
            other = np.zeros(len(table) - 1, bool)
            for k in keys:
                at = codes(table.column(k))
                other |= at[1:] != at[:-1]
            f = codes(table.column(frame))
            edges = np.flatnonzero(np.r_[True, other | (f[1:] != f[:-1])])
            new = np.r_[not goes_on, other][edges]
            waiting = table.slice(int(edges[-1]))  # this frame may go on
            goes_on = not new[-1]
            if len(edges) > 1:
                yield from done(table.slice(0, int(edges[-1])), edges, new[:-1])
        if waiting is not None:
            yield from done(waiting, np.array([0, len(waiting)]), np.array([not goes_on]))

    return work


def track_in_chunks(detections: DataFrame, by: list[str], frame: str, conf: str, p: Association, chunk: int) -> DataFrame:
    """track() by tasks of `chunk` frames. A chunk goes on for twice the buffer into the next one, so a track that is lost at the seam is
    met again on both sides or on neither. Tracks of two chunks are the same if they hold the same boxes there, the most first, each
    once; chains of such pairs get one number, in order of their first frames.

    A chunk doesn't know how fast a box moved before its first frame, so a box in a crowd may change its number at a seam;
    tests measure how often.
    """
    ship(detections.sparkSession)
    seam = min(2 * p.buffer, chunk)
    rows = stored(detections.withColumn("_row", F.monotonically_increasing_id()), "detections")
    home = F.floor(F.col(frame) / chunk)
    chunks = F.when((F.col(frame) - home * chunk) < seam, F.array(home - 1, home)).otherwise(F.array(home))
    cut = rows.select(*by, frame, conf, *BOX, "_row", F.explode(chunks).alias("_chunk"), home.alias("_home"))
    names, keys = [*by, "_row", "_chunk", "_home", frame], [*by, "_chunk"]
    cut = cut.filter(F.col(frame).isNotNull()).repartition(*keys).sortWithinPartitions(*keys, frame, F.desc(conf), *BOX, "_row")
    kind = T.StructType([*cut.schema.fields, T.StructField("track", T.LongType())])
    # a chunk that only goes on into the first rows of a group has nothing of its own
    found = stored(cut.mapInArrow(_streamed(keys, frame, conf, p, "_home"), kind).select(*names, "track"), "chunk-tracks")
    of = F.struct(F.lit(0), *by).alias("_of")
    nodes = stored(found.groupBy(*by, "_chunk", "track").agg(F.min(frame).alias("_first")).withColumn("node", F.monotonically_increasing_id()), "chunk-track-nodes")
    node = nodes.select(of, "_chunk", "track", "node")
    before = found.filter("_chunk < _home").select(of, "_chunk", "track", "_row").join(node, ["_of", "_chunk", "track"]).select("_row", "_of", "_chunk", F.col("node").alias("a"))
    after = found.filter("_chunk = _home").select(of, "_chunk", "track", "_row").join(node, ["_of", "_chunk", "track"]).select("_row", F.col("node").alias("b"))
    shared = before.join(after, "_row").groupBy("_of", "_chunk", "a", "b").agg(F.count("*").alias("n"))
    same = joins.greedy_pairs(shared, ["_of", "_chunk"], "a", "b", "n")
    whole = components(same.select("a", "b"), nodes.select("node"))
    first = nodes.join(whole, "node")
    first = first.groupBy(*by, "component").agg(F.min(F.struct("_first", "_chunk", "track")).alias("_at"))
    number = first.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_at", "component")).cast("long"))
    named = node.join(whole, "node").join(number.select("component", "_n"), "component").select("_of", "_chunk", "track", "_n")
    own = found.filter("_chunk = _home").select(of, "_chunk", "track", "_row").join(named, ["_of", "_chunk", "track"]).select("_row", F.col("_n").alias("track"))
    return rows.join(own, "_row", "left").drop("_row")


def nearest_to_recent(points: DataFrame, by: list[str], frame: str, frames: int = 10, size: int = 100_000, then: tuple = ()) -> DataFrame:
    """One row of each frame: that nearest to the mean of all rows (x, y) of the last `frames` frames that have rows, the frame itself included;
    ties go by x, then y, then the columns `then`, without which rows at one place tie for good.

    A choice doesn't depend on those before, so a group's frames are numbered and go in chunks of `size`, of which each gets the last few frames of
    the chunk before.
    """
    of = F.struct(F.lit(0), *by)
    sums = points.groupBy(of.alias("_of"), F.col(frame).alias("_f")).agg(F.sum("x").alias("_x"), F.sum("y").alias("_y"), F.count("*").alias("_n"))
    placed = numbered(sums, ["_of"], ["_f"], "_p")
    chunks = F.array_distinct(F.array(F.expr(f"_p div {size}"), F.expr(f"(_p + {frames - 1}) div {size}")))
    placed = placed.withColumn("_k", F.explode(chunks))
    last = Window.partitionBy("_of", "_k").orderBy("_p").rangeBetween(1 - frames, 0)
    mean = lambda c: (F.sum(c).over(last) / F.sum("_n").over(last)).alias(f"{c}m")
    centres = placed.select("_of", "_f", "_p", "_k", mean("_x"), mean("_y")).filter(f"_k = _p div {size}").drop("_p", "_k")
    near = points.withColumn("_of", of).withColumn("_f", F.col(frame)).join(centres, ["_of", "_f"])
    far = F.sqrt((F.col("x") - F.col("_xm")) * (F.col("x") - F.col("_xm")) + (F.col("y") - F.col("_ym")) * (F.col("y") - F.col("_ym")))
    first = Window.partitionBy("_of", "_f").orderBy(far, "x", "y", *then)
    return near.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select(*points.columns)


class Ring:
    """Frames about triggers: the last `before` frames are held; a trigger lets them and the next `after` ones go as a clip, and for
    `skip` frames no other trigger counts."""

    def __init__(self, before: int = 150, after: int = 150, skip: int = 900):
        self.after, self.skip = after, skip
        self.held: deque = deque(maxlen=before)
        self.clip, self.left, self.wait = 0, 0, 0

    def push(self, frame: int, trigger: bool) -> list[tuple[int, int]]:
        """(clip, frame) rows that leave now."""
        out = []
        if trigger and self.wait == 0:
            self.clip, self.left, self.wait = self.clip + 1, self.after, self.skip
            out = [(self.clip, f) for f in self.held]
            self.held.clear()
        self.wait = max(0, self.wait - 1)
        if self.left:
            self.left -= 1
            out.append((self.clip, frame))
        else:
            self.held.append(frame)
        return out


def ring_clips(frames: DataFrame, by: list[str], frame: str, trigger: str, before: int = 150, after: int = 150, skip: int = 900) -> DataFrame:
    """(by, clip, frame) of rows (by, frame, trigger), one group, such as a file, at a time; state starts anew with each."""
    ship(frames.sparkSession)
    schema = T.StructType([*[frames.schema[c] for c in by], T.StructField("clip", T.LongType()), T.StructField("frame", T.LongType())])

    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(frame, kind="stable")
        ring = Ring(before, after, skip)
        rows = [r for f, t in zip(g[frame], g[trigger]) for r in ring.push(int(f), bool(t))]
        return pd.DataFrame([(*[g[c].iloc[0] for c in by], *r) for r in rows], columns=[*by, "clip", "frame"])

    return frames.groupBy(*by).applyInPandas(work, schema)
