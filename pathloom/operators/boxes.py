"""Operators on detection boxes: pairs, suppression, enclosed boxes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..session import ship

BOX = ("x1", "y1", "x2", "y2")
#: Rows that suppress() looks at together, but for a larger image.
RUN_ROWS = 20_000
#: Boxes of an image from which on suppress() takes it by itself.
ALONE = 512
#: Sides of a tile of overlapping() in cells; boxes of a tile beyond which it is cut into blocks, which meet two by two in tasks of their own.
TILE, BLOCK = 4, 50_000
#: Boxes that overlapping() packs together before they go to their tiles, and boxes of a packed row at most: 10 000 such rows make an Arrow batch.
PACK, PART = 1 << 19, 512
#: Boxes that near() looks around together, and candidates that it tests together: few, so that their columns stay in a core's cache.
SLICE, CHUNK = 1024, 1 << 14


def box(prefix: str = "") -> tuple:
    return tuple(F.col(prefix + c) for c in BOX)


def _in_cells(df: DataFrame, cell: float, prefix: str = "") -> DataFrame:
    """A row for each cell of the grid that a box touches: _cx and _cy."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(prefix + lo) / cell), F.floor(F.greatest(prefix + lo, prefix + hi) / cell))
    return df.withColumn("_cx", F.explode(span("x1", "x2"))).withColumn("_cy", F.explode(span("y1", "y2")))


def _touching(a: DataFrame, b: DataFrame, on: list[str], cell: float | None) -> DataFrame:
    """Rows of `a` and `b`, boxes a_ and b_, of one image; with `cell`, those alone that share a point. A pair meets in all cells that both
    touch, and is kept in the one that holds the first corner of what they share."""
    if cell is None:
        return a.join(b, on)
    both = _in_cells(a, cell, "a_").join(_in_cells(b, cell, "b_"), [*on, "_cx", "_cy"])
    own = lambda c: F.floor(F.greatest(f"a_{c}", f"b_{c}") / cell)
    meet = lambda lo, hi: F.greatest(f"a_{lo}", f"b_{lo}") <= F.least(f"a_{hi}", f"b_{hi}")
    return both.filter((F.col("_cx") == own("x1")) & (F.col("_cy") == own("y1")) & meet("x1", "x2") & meet("y1", "y2")).drop("_cx", "_cy")


def pairs(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str, kind: str = "iou", least: float | None = None, cell: float | None = None) -> DataFrame:
    """(on, left_id, right_id, value) for the boxes of the same image; value by functions.boxes.iou or 'ioa' (share of the right box).

    For crowded images give a `cell`, about as wide as most boxes: then boxes meet where a grid of such cells says that they touch, not all
    with all. That takes a `least` above 0, for boxes that don't overlap aren't seen.
    """
    if cell is not None and (least is None or least <= 0 or kind not in ("iou", "ioa")):
        raise ValueError("a grid finds overlapping boxes only: give `least`, and iou or ioa")
    a = left.select(*on, F.col(left_id).alias("_l"), *[F.col(c).alias(f"a_{c}") for c in BOX])
    b = right.select(*on, F.col(right_id).alias("_r"), *[F.col(c).alias(f"b_{c}") for c in BOX])
    value = B.over_second(box("a_"), box("b_")) if kind == "ioa" else B.iou(box("a_"), box("b_"), kind)
    out = _touching(a, b, on, cell).select(*on, F.col("_l").alias("left_id"), F.col("_r").alias("right_id"), value.alias("value"))
    return out if least is None else out.filter(F.col("value") >= least)


def near(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, group: np.ndarray, cx: np.ndarray, cy: np.ndarray, side: float, least: float):
    """Yields (rows, other rows, iou) of the boxes of one group and tile, cx and cy on a grid of that side, whose iou is `least` (above 0) or
    more; each pair once, in the tile that holds the first corner of what its boxes share.

    Such boxes are alike in size: neither area is below `least` times the other, and they share least / (1 + least) of both areas' sum. So boxes
    are put into classes of size, each in rows of its own height sorted by x1, and a box looks at those classes and stretches of rows alone that
    leave it as much to share.
    """
    at = np.lexsort((x1, group))
    x1, y1, x2, y2, group, cx, cy = (v[at] for v in (x1, y1, x2, y2, group, cx, cy))
    w, h = x2 - x1, y2 - y1
    size, left, low = w * h, cx * side, cy * side
    step = np.log(1 / min(least, 0.9)) / 2 * (1 + 1e-9)  # classes of the square root of the area: alike ones are the same or neighbours
    cls = np.floor(np.log(np.clip(np.sqrt(size) / side, 1 / 4096, 4096)) / step).astype(np.int64)
    cls -= cls.min()
    k = int(cls.max()) + 1
    widest, tallest, smallest = np.zeros(k), np.zeros(k), np.full(k, np.inf)
    np.maximum.at(widest, cls, w), np.maximum.at(tallest, cls, h), np.minimum.at(smallest, cls, size)
    typical = np.sqrt(np.where(np.isfinite(smallest), smallest, 1.0))
    row = np.maximum(np.maximum(typical / 2, tallest / 1024), side / 16384)
    of = np.floor((y1 - low) / row[cls]).astype(np.int64)
    first = int(of.min())
    rows, fine = int(of.max()) - first + 1, 1 << 16
    place = lambda x, tile: np.clip((x - tile) / side * fine, 0, fine - 1).astype(np.int64)
    inside = np.flatnonzero(np.floor(x1 / side) == cx)  # the later box of a pair begins in the tile
    key = (((group * k + cls) * rows + of - first) * fine + place(x1, left))[inside]
    order = np.argsort(key, kind="stable")
    key, inside = key[order], inside[order]
    bx1, by1, bx2, by2, bsize = (v[inside] for v in (x1, y1, x2, y2, size))
    for start in range(0, len(x1), SLICE):
        mine = np.arange(start, min(start + SLICE, len(x1)))
        a, c = np.repeat(mine, 3), (cls[mine, None] + [-1, 0, 1]).ravel()
        known = (c >= 0) & (c < k)
        a, c = a[known], c[known]
        a, c = a[tallest[c] > 0], c[tallest[c] > 0]
        y = y1[a] - low[a]
        below, above = (1 - least) * np.minimum(h[a] / least, tallest[c]), (1 - least) * h[a]
        blur = 1e-9 * (np.abs(y1[a]) + np.abs(y2[a]))
        one = np.maximum(np.floor((y - below - blur) / row[c]).astype(np.int64), first)
        n = np.maximum(np.minimum(np.floor((y + above + blur) / row[c]).astype(np.int64), first + rows - 1) - one + 1, 0)
        line = np.repeat(one - np.cumsum(n) + n, n) + np.arange(n.sum())
        a, c, y, blur = np.repeat(a, n), np.repeat(c, n), np.repeat(y, n), np.repeat(blur, n)
        # the most that boxes of this row share with the box: in height, and so in width
        high = np.minimum(np.minimum(h[a], tallest[c]), np.minimum(y + h[a] - line * row[c], (line + 1) * row[c] + tallest[c] - y)) + blur
        share = np.maximum(least * np.maximum(size[a], smallest[c]), least / (1 + least) * (size[a] + smallest[c]))
        wide = share / np.maximum(high, 1e-300)
        spare = w[a] - wide + 1e-9 * (np.abs(x1[a]) + np.abs(x2[a]) + w[a])
        seen = (high > 0) & (spare >= 0) & (wide <= widest[c] * (1 + 1e-9) + 1e-9 * np.abs(x2[a]))
        a, c, line, spare = a[seen], c[seen], line[seen], spare[seen]
        line = ((group[a] * k + c) * rows + line - first) * fine
        lo = np.searchsorted(key, line + place(x1[a], left[a]))
        n = np.searchsorted(key, line + place(x1[a] + spare, left[a]), "right") - lo
        a, lo, n = a[n > 0], lo[n > 0], n[n > 0]
        ends = np.cumsum(n)
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - n[i] + CHUNK, "right")))
            m = n[i:j]
            one, other = np.repeat(a[i:j], m), np.repeat(lo[i:j] - ends[i:j] + m, m) + np.arange(ends[i] - n[i], ends[j - 1])
            i = j
            both = np.maximum(np.minimum(x2[one], bx2[other]) - bx1[other], 0) * np.maximum(np.minimum(y2[one], by2[other]) - np.maximum(y1[one], by1[other]), 0)
            value = both / (size[one] + bsize[other] - both + B.EPS)
            hit = np.flatnonzero(value >= least)
            one, other, value = one[hit], inside[other[hit]], value[hit]
            own = (one < other) & (np.floor(np.maximum(y1[one], y1[other]) / side) == cy[one])
            if own.any():
                yield at[one[own]], at[other[own]], value[own]


def _short(v: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`v`, and the least value of each run of it, from the rows `first` on; where all are whole numbers above that, `v` is what they are above
    it, in as few bytes as these take."""
    least = np.minimum.reduceat(v, first)
    at = np.repeat(least, np.diff(np.r_[first, len(v)]))
    with np.errstate(over="ignore"):
        above = v - at
    if above.min() >= 0 and above.max() < 1 << 32:
        above = above.astype(np.uint32)
        if (at + above == v).all():
            return above.astype(np.min_scalar_type(int(above.max()))), least
    return v, least


def packed(table: pa.Table, keys: list[str], values: list[str], part: int) -> pa.Table:
    """(keys, _n, and of each of `values` its bytes and `_least_` value): rows of the same keys as one, `part` of them at most."""
    key, top = np.zeros(len(table), np.int64), 1
    for c in keys:
        code = table.column(c).combine_chunks().dictionary_encode().indices.to_numpy()
        span = int(code.max()) + 1
        if top * span > 1 << 62:
            key, top = np.unique(key, return_inverse=True)[1], len(table)
        key, top = key * span + code, top * span
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    place = np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)]))
    first = np.flatnonzero(place % part == 0)
    n = np.diff(np.r_[first, len(key)])
    out = table.select(keys).take(pa.array(order[first])).append_column("_n", pa.array(n, pa.int32()))
    for c in values:
        v, least = _short(table.column(c).to_numpy()[order], first)
        ends = np.r_[0, np.cumsum(n)].astype(np.int32) * np.int32(v.itemsize)
        out = out.append_column(c, pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(v)])).append_column(f"_least_{c}", pa.array(least))
    return out


def unpacked(table: pa.Table, c: str, n: np.ndarray) -> np.ndarray:
    """The values `c` of rows that packed() made, `n` of each."""
    out, size = np.repeat(table.column(f"_least_{c}").to_numpy(), n), pc.binary_length(table.column(c)).to_numpy() // n
    for width in np.unique(size).tolist():
        these = size == width
        raw, rows = b"".join(table.column(c).filter(pa.array(these)).to_pylist()), np.repeat(these, n)
        out[rows] = np.frombuffer(raw, out.dtype) if width == 8 else out[rows] + np.frombuffer(raw, f"u{width}")
    return out


def overlapping(df: DataFrame, on: list[str], id_col: str, least: float, cell: float, digits: int | None = None) -> DataFrame:
    """(on, left_id, right_id, value): as pairs() of `df` with itself by iou, each pair once, left_id < right_id; ids are integers, `least` is above 0.
    Values of `least` and more are rounded to `digits`, halves up: here, for in a column expression that would take longer than all the rest.

    For crowded images: boxes meet in tiles, TILE times as wide as `cell`, which is about the width of most boxes. A tile of more than BLOCK boxes
    is cut into blocks that meet two by two, so a task holds a run of RUN_ROWS boxes, or twice BLOCK or so, and CHUNK candidates of them at a time.
    Boxes go to their tiles packed: those of a tile among PACK of a task as one row, whole numbers in one to four bytes.
    """
    if least <= 0:
        raise ValueError("a grid finds overlapping boxes only: give a `least` above 0")
    ship(df.sparkSession)
    side, tile = cell * TILE, [*on, "_cx", "_cy"]
    rows = df.select(*on, F.col(id_col).cast("long").alias("_id"), *[F.col(c).cast("double").alias(c) for c in BOX]).filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    rows = _in_cells(rows.dropna(), side)
    crowds = rows.groupBy(*tile).agg(F.count("*").alias("_n")).filter(F.col("_n") > BLOCK).withColumn("_n", F.ceil(F.col("_n") / BLOCK))
    rows = rows.join(F.broadcast(crowds), tile, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))  # a row for every BLOCK rows at most
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_id", *BOX), "_n")).withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    rows = rows.withColumn("_i", F.least("_b", "_s")).withColumn("_j", F.greatest("_b", "_s")).drop("_n", "_s")
    group, names, values = ["_cx", "_cy", "_i", "_j", *on], [*on, "left_id", "right_id", "value"], ["_id", *BOX]

    def together(batches):
        waiting, n = [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            n += len(batch)
            if n >= PACK:
                yield from packed(pa.concat_tables(waiting), [*group, "_b"], values, PART).combine_chunks().to_batches()
                waiting, n = [], 0
        if n:
            yield from packed(pa.concat_tables(waiting), [*group, "_b"], values, PART).combine_chunks().to_batches()

    def found(table: pa.Table, new: np.ndarray):
        n = table.column("_n").to_numpy()
        of = np.repeat(np.arange(len(n)), n)
        cx, cy, i, j, block = (table.column(c).to_numpy()[of] for c in ("_cx", "_cy", "_i", "_j", "_b"))
        ids = unpacked(table, "_id", n)
        for a, b, value in near(*[unpacked(table, c, n) for c in BOX], np.cumsum(new)[of], cx, cy, side, least):
            left, right = ids[a], ids[b]
            fine = (left != right) & ((i[a] == j[a]) | (block[a] != block[b]))
            a, left, right, value = a[fine], left[fine], right[fine], value[fine]
            if digits is not None:
                value = np.floor(value * 10.0**digits + 0.5) / 10.0**digits
            same = table.select(on).take(pa.array(of[a]))
            yield pa.Table.from_arrays([*same.columns, pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(value)], names)

    def joined(tables):
        waiting, n = [], 0
        for table in tables:
            waiting.append(table)
            n += len(table)
            if n >= RUN_ROWS:
                yield from pa.concat_tables(waiting).combine_chunks().to_batches()
                waiting, n = [], 0
        if n:
            yield from pa.concat_tables(waiting).combine_chunks().to_batches()

    def changes(table: pa.Table) -> np.ndarray:
        n, new = len(table), np.zeros(max(len(table) - 1, 0), bool)
        for c in group:
            v = table.column(c)
            new |= pc.not_equal(v.slice(1), v.slice(0, n - 1)).to_numpy()
        return np.r_[True, new][:n]

    def cut(batches):
        for batch in batches:
            table, boxes = pa.Table.from_batches([batch]), np.cumsum(batch.column("_n").to_numpy())
            edges = [0, *(np.flatnonzero(np.diff(boxes // RUN_ROWS)) + 1).tolist(), len(table)]
            yield from (table.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:]) if hi > lo)

    def runs(batches):
        waiting, n = [], 0
        for table in cut(batches):
            waiting.append(table)
            n += pc.sum(table.column("_n")).as_py()
            if n < RUN_ROWS:
                continue
            table = pa.concat_tables(waiting).combine_chunks()
            new = changes(table)
            last = int(np.flatnonzero(new)[-1])  # this group may go on
            if last:
                yield from found(table.slice(0, last).combine_chunks(), new[:last])
                table = table.slice(last)
            waiting, n = [table], pc.sum(table.column("_n")).as_py()
        if n:
            table = pa.concat_tables(waiting).combine_chunks()
            yield from found(table, changes(table))

    kind = {c: f"`{c}` {df.schema[c].dataType.simpleString()}" for c in on}
    packs = ", ".join([*[kind.get(c, f"{c} long") for c in group], "_b long, _n int, _id binary, _least__id long", *[f"{c} binary, _least_{c} double" for c in BOX]])
    rows = rows.select(*group, "_b", *values).mapInArrow(together, packs)
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(lambda batches: joined(runs(batches)), ", ".join([*[kind[c] for c in on], "left_id long, right_id long, value double"]))


def without_enclosed(df: DataFrame, by: list[str], id_col: str, containment: float = 0.9, ratio: float = 0.6, cell: float | None = None) -> DataFrame:
    """Drops a box that a larger one of the same `by` holds: intersection over the smaller area >= containment and area ratio <= ratio. `cell`
    as for pairs()."""
    a = df.select(*by, F.col(id_col).alias("_l"), *[F.col(c).alias(f"a_{c}") for c in BOX])
    b = df.select(*by, F.col(id_col).alias("_r"), *[F.col(c).alias(f"b_{c}") for c in BOX])
    one, two = box("a_"), box("b_")
    holds = (F.col("_l") != F.col("_r")) & (B.area(two) > B.area(one)) & (B.over_smaller(one, two) >= containment) & (B.area_ratio(one, two) <= ratio)
    if cell is None or containment <= 0:
        own = df.select("*", F.col(id_col).alias("_l"), *[F.col(c).alias(f"a_{c}") for c in BOX], *[F.col(c).alias(f"_by_{c}") for c in by])
        for c in by:
            holds = holds & (F.col(f"_by_{c}") == F.col(f"_o_{c}"))
        return own.join(b.withColumnsRenamed({c: f"_o_{c}" for c in by}), holds, "left_anti").select(*df.columns)
    gone = _touching(a, b, by, cell).filter(holds).select(*by, F.col("_l").alias(id_col)).distinct()
    return df.join(gone, [*by, id_col], "left_anti").select(*df.columns)


def uncovered(df: DataFrame, others: DataFrame, on: list[str], id_col: str, most: float = 0.5, kind: str = "iou", cell: float | None = None) -> DataFrame:
    """Boxes of `df` that no box of `others` of the same image overlaps by more than `most`; `kind` and `cell` as for pairs()."""
    tagged = others.select(*on, *BOX, F.lit(0).alias("_o"))
    hit = pairs(tagged, df, on, "_o", id_col, kind, max(most, 1e-12), cell).filter(F.col("value") > most)
    return df.join(hit.select(*on, F.col("right_id").alias(id_col)).distinct(), [*on, id_col], "left_anti").select(*df.columns)


def class_candidates(df: DataFrame, scores: str, conf: float = 0.25, many: bool = True, classes: list[int] | None = None) -> DataFrame:
    """(other columns of df, cls, conf): detections as suppress() takes them, from an array of a score for each class.

    With `many` a box stands once for every class scored above `conf`, else for its best class alone (ties: the first one). `classes` are
    the wanted class numbers, None all. Scores that are null or not a number count for nothing.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != scores]
    fine = F.transform(F.col(scores), lambda v: F.when(~F.isnan(v), v))
    if many:
        out = df.select(*others, F.posexplode(fine).alias("cls", "conf"))
    else:
        out = df.select(*others, (F.array_position(fine, F.array_max(fine)) - 1).cast("int").alias("cls"), F.array_max(fine).alias("conf"))
    out = out.filter(F.col("conf") > conf)
    return out if classes is None else out.filter(F.col("cls").isin(classes))


def kept_boxes(b: np.ndarray, cls: np.ndarray, starts: np.ndarray, n: np.ndarray, iou: float, top: int | None) -> np.ndarray:
    """The rows that suppress() keeps of images of `n` boxes (x1, y1, x2, y2), best first, from the rows `starts` on.

    Images go in turns together: the best box left in each stays, and what it suppresses there goes. Only large ones go by themselves.
    """
    size = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    out = []

    def suppressed(by, at) -> np.ndarray:
        w = np.minimum(b[by, 2], b[at, 2]) - np.maximum(b[by, 0], b[at, 0])
        h = np.minimum(b[by, 3], b[at, 3]) - np.maximum(b[by, 1], b[at, 1])
        both = np.clip(w, 0, None) * np.clip(h, 0, None)
        return (both / (size[by] + size[at] - both + 1e-7) > iou) & (cls[at] == cls[by])

    large = n > ALONE
    for start, k in zip(starts[large], n[large]):
        alive, kept = np.ones(k, bool), []
        for i in range(k):
            if alive[i]:
                kept.append(start + i)
                if len(kept) == top:
                    break
                alive[i:] &= ~suppressed(start + i, slice(start + i, start + k))
        out.append(np.array(kept))
    starts, n = starts[~large], n[~large]
    of = np.repeat(np.arange(len(n)), n)
    at, turn = np.arange(len(of)) + np.repeat(starts - np.cumsum(n) + n, n), 0
    while len(at) and (top is None or turn < top):
        first = np.r_[True, of[1:] != of[:-1]]
        out.append(at[first])
        by, at, of = at[first][np.cumsum(first) - 1][~first], at[~first], of[~first]
        left = ~suppressed(by, at)
        at, of, turn = at[left], of[left], turn + 1
    return np.sort(np.concatenate([np.zeros(0, int), *out]))


def suppress(df: DataFrame, image: str, conf: float = 0.25, iou: float = 0.45, top: int | None = 300, most: int | None = 30_000, per_class: bool = True) -> DataFrame:
    """Non-maximum suppression within each image: (df columns) of the boxes that stay, best first.

    The best `most` boxes of an image are looked at and `top` of them kept at most; None sets no bound. Ties of confidence go by x1, y1,
    x2, y2, cls. Images are sorted within partitions and stream through a worker in runs of RUN_ROWS boxes or one image's best ones, of which a
    task holds one run.
    """
    ship(df.sparkSession)
    names = df.columns

    def kept(table: pa.Table, edges: np.ndarray) -> list[pa.RecordBatch]:
        b = np.stack([table.column(c).cast(pa.float64()).to_numpy() for c in BOX], 1)
        cls = codes(table.column("cls")) if per_class else np.zeros(len(table), int)
        starts, n = edges[:-1], np.diff(edges) if most is None else np.minimum(np.diff(edges), most)
        rows = kept_boxes(b, cls, starts, n, iou, top)
        return table.take(pa.array(rows, pa.int64())).combine_chunks().to_batches()

    def codes(column: pa.ChunkedArray) -> np.ndarray:
        return pc.fill_null(column.combine_chunks().dictionary_encode().indices, -1).to_numpy()

    def work(batches):
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            rows += len(batch)
            if rows < RUN_ROWS:
                continue
            table = pa.concat_tables(waiting).combine_chunks()
            name = codes(table.column(image))
            edges = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            if len(edges) > 1:
                yield from kept(table.slice(0, int(edges[-1])), edges)
            last = table.slice(int(edges[-1]))  # this image may go on; beyond the best ones nothing of it is held
            waiting = [last if most is None else last.slice(0, most)]
            rows = 0 if most is not None and len(waiting[0]) >= most else len(waiting[0])
        if waiting:
            table = pa.concat_tables(waiting).combine_chunks()
            name = codes(table.column(image))
            yield from kept(table, np.flatnonzero(np.r_[True, name[1:] != name[:-1], True]) if len(name) else np.array([0]))

    rows = df.filter(F.col("conf") >= conf).repartition(image).sortWithinPartitions(image, F.desc("conf"), *BOX, "cls")
    return rows.select(*names).mapInArrow(work, df.schema)
