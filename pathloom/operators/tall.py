"""Sequences in tall form: arrays and rows, runs and islands, gaps, windows and folds.

`by` names the columns of an entity. All of it stays in Catalyst; windows are partitioned by entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(by: list[str], order, *more):
    return Window.partitionBy(*by).orderBy(order, *more)


def arrays_to_rows(df: DataFrame, arrays: list[str], keep: list[str], position: str | None = None) -> DataFrame:
    """Parallel arrays as rows; shorter arrays give nulls, empty ones no row."""
    zipped = F.arrays_zip(*arrays)
    if position:
        return df.select(*keep, F.posexplode(zipped).alias(position, "_z")).select(*keep, position, *[F.col(f"_z.{a}").alias(a) for a in arrays])
    return df.select(*keep, F.inline(zipped))


def rows_to_arrays(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row for each entity with its columns as arrays in order."""
    packed = F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order])))
    out = df.groupBy(*by).agg(packed.alias("_p"))
    return out.select(*by, *[F.col("_p")[c].alias(c) for c in dict.fromkeys([order, *columns])])


def islands(df: DataFrame, by: list[str], order: str, gap: int = 1, name: str = "island") -> DataFrame:
    """Numbers the runs of each entity in which neighbours are at most `gap` apart."""
    w = _w(by, order)
    new = F.when(F.col(order) - F.lag(order).over(w) <= gap, 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def spans(df: DataFrame, by: list[str], order: str, gap: int = 1, least: int = 1) -> DataFrame:
    """Islands of at least `least` rows as (by, start, end, n)."""
    out = islands(df, by, order, gap).groupBy(*by, "island").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= least).drop("island")


def runs(df: DataFrame, by: list[str], order: str, flag: str) -> DataFrame:
    """Runs of equal `flag` in order of rows (not of values of `order`): (by, flag, start, end, n)."""
    w = _w(by, order)
    changed = F.when(F.lag(flag).over(w).eqNullSafe(F.col(flag)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    out = df.withColumn("_c", changed).withColumn("_r", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.groupBy(*by, "_r").agg(F.first(flag).alias(flag), F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("n")).drop("_r")


def fill_gaps(df: DataFrame, by: list[str], order: str, flag: str, longest: int) -> DataFrame:
    """Adds `filled`: false runs of at most `longest` rows between true ones become true; leading and trailing ones stay."""
    w = _w(by, order)
    df = df.withColumn("_i", F.row_number().over(w)).withColumn("_on", F.when(F.col(flag), F.col("_i")))
    back = F.last("_on", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # the next one, as the last in falling order: a frame that grows costs a step a row, one that shrinks all that is left
    ahead = F.last("_on", True).over(_w(by, F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("filled", F.col(flag) | F.coalesce(ahead - back - 1 <= longest, F.lit(False))).drop("_i", "_on")


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str, touching: bool = True) -> DataFrame:
    """Overlapping intervals of each entity merged: (by, start, end, n); touching ones too unless told otherwise."""
    w = _w(by, start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    joins = F.col(start) <= seen if touching else F.col(start) < seen
    out = df.withColumn("_new", F.when(joins, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.groupBy(*by, "_g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_g")


def interpolate(df: DataFrame, by: list[str], order: str, values: list[str]) -> DataFrame:
    """A row for every integer of `order` between an entity's first and last, values linear in between.

    Only neighbours are looked at: each row is spread up to the next, so nothing but the result's rows is made. Rows that share a
    value of `order` are averaged first.
    """
    one = df.groupBy(*by, order).agg(*[F.avg(v).alias(v) for v in values])
    w = _w(by, order)
    nxt = F.coalesce(F.lead(order).over(w), F.col(order) + 1)
    out = one.select(*by, F.col(order).alias("_a"), nxt.alias("_b"), *[F.col(v) for v in values], *[F.lead(v).over(w).alias(f"_n_{v}") for v in values])
    out = out.withColumn(order, F.explode(F.sequence("_a", F.col("_b") - 1)))
    share = (F.col(order) - F.col("_a")) / (F.col("_b") - F.col("_a"))
    return out.select(*by, order, *[F.when(F.col(order) == F.col("_a"), F.col(v)).otherwise(F.col(v) + (F.col(f"_n_{v}") - F.col(v)) * share).alias(v) for v in values])


def bridge(df: DataFrame, by: list[str], order: str, values: list[str], flag: str) -> DataFrame:
    """Replaces values over runs of true `flag` by the straight line between the run's first and last row."""
    w = _w(by, order)
    out = df.withColumn("_c", F.when(F.lag(flag).over(w) == F.col(flag), 0).otherwise(1)).withColumn("_r", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*by, "_r").orderBy(order)
    n, i, whole = F.count("*").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.row_number().over(run) - 1, run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for v in values:
        out = out.withColumn(f"_n_{v}", F.when(F.col(flag) & (n > 1), F.first(v).over(whole) + (F.last(v).over(whole) - F.first(v).over(whole)) * i / (n - 1)).otherwise(F.col(v)))
    return out.select(*[F.col(f"_n_{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def fold(df: DataFrame, by: list[str], item: Column, start: Column, step, out: str = "state") -> DataFrame:
    """Folds an entity's rows, in order of the struct `item`, by `step(state, item)`; a state for each entity."""
    return df.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("_items")).select(*by, F.aggregate("_items", start, step).alias(out))


def clip_windows(df: DataFrame, by: list[str], at: str, before: int, after: int) -> DataFrame:
    """Windows [at - before, at + after) merged where they overlap or touch: (by, start, end, first trigger)."""
    w = df.select(*by, F.greatest(F.col(at) - before, F.lit(0)).alias("start"), (F.col(at) + after).alias("end"), F.col(at).alias("_t"))
    order = _w(by, "start", "end")
    seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    w = w.withColumn("_new", F.when(F.col("start") <= seen, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return w.groupBy(*by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("_t").alias("trigger")).drop("_g")


def carry_forward(column: str, by: list[str], order: str) -> Column:
    """The last value that isn't null, up to this row."""
    return F.last(column, True).over(_w(by, order).rowsBetween(Window.unboundedPreceding, 0))


def running_offset(df: DataFrame, by: list[str], order: str, length: str, name: str = "first") -> DataFrame:
    """Adds where each part begins if an entity's parts are laid end to end."""
    return df.withColumn(name, F.coalesce(F.sum(length).over(_w(by, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def sampled_speed(df: DataFrame, by: list[str], order: str, position: str, stride: int, fps: float, unit: float = 0.1) -> DataFrame:
    """Every stride-th row of each entity by position, with the distance in metres and the speed in km/h since the one before."""
    kept = df.filter((F.col(position) - 1) % stride == 0)
    w = _w(by, position)
    dx, dy = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    metres = F.sqrt(dx * dx + dy * dy) * unit
    seconds = (F.col(order) - F.lag(order).over(w)) / F.lit(fps)
    return kept.withColumn("metres", metres).withColumn("kmh", F.when(seconds > 0, metres / seconds * 3.6)).filter(F.col("metres").isNotNull())


def tumbling(df: DataFrame, duration: str, length: int) -> DataFrame:
    """Windows of fixed length over [0, duration), the last one cut short: start and end columns."""
    out = df.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(duration) - 1, F.lit(0)).cast("long"), F.lit(length).cast("long"))))
    return out.withColumn("end", F.least(F.col("start") + length, F.col(duration)))


def sliding(df: DataFrame, order: str, size: int, step: int, name: str = "window") -> DataFrame:
    """A row for each window [k * step, k * step + size) that holds it."""
    first = F.greatest(F.floor((F.col(order) - size) / step) + 1, F.lit(0))
    return df.withColumn(name, F.explode(F.sequence(first, F.floor(F.col(order) / step))))


def centre_span(df: DataFrame, by: list[str], order: str, length: int) -> DataFrame:
    """The rows in the last `length` before the middle of each entity's span."""
    whole = Window.partitionBy(*by)
    middle = F.floor((F.min(order).over(whole) + F.max(order).over(whole)) / 2)
    return df.withColumn("_m", middle).filter(F.col(order).between(F.col("_m") - length, F.col("_m"))).drop("_m")


def patience(df: DataFrame, by: list[str], order: str, value: str, wait: int) -> DataFrame:
    """Adds `stop`: no new best in the last `wait` steps."""
    w = _w(by, order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_best", F.max(value).over(w))
    at = F.max(F.when(F.col(value) == F.col("_best"), F.col(order))).over(w)
    return df.withColumn("stop", F.col(order) - at >= wait).drop("_best")


#: Units of order that one task of the two-level windows below holds.
CHUNK = 100_000


def previous(df: DataFrame, by: list[str], order: str, columns: list[str], size: int = CHUNK, ahead: bool = False) -> DataFrame:
    """Adds prev_<c> (next_<c> with `ahead`): the columns of the row before. Rows are windowed in chunks of `order`; what
    stands at a chunk's end goes to the next one by a table of a row a chunk, so a long match without further keys isn't one task."""
    df = df.withColumn("_k", F.floor(F.col(order) / size))
    edge = (F.min_by if ahead else F.max_by)(F.struct(*columns), order)
    shift = F.lead if ahead else F.lag
    edges = df.groupBy(*by, "_k").agg(edge.alias("_l")).withColumn("_l", shift("_l").over(Window.partitionBy(*by).orderBy("_k")))
    w = Window.partitionBy(*by, "_k").orderBy(order)
    mine = F.row_number().over(w.orderBy(F.desc(order)) if ahead else w) == 1
    out = df.join(edges, [*by, "_k"]).withColumn("_p", F.when(mine, F.col("_l")).otherwise(shift(F.struct(*columns)).over(w)))
    for c in columns:
        out = out.withColumn(f"{'next' if ahead else 'prev'}_{c}", F.col(f"_p.{c}"))
    return out.drop("_k", "_l", "_p")


def changes(df: DataFrame, by: list[str], order: str, columns: list[str], name: str, size: int = CHUNK) -> DataFrame:
    """Numbers the runs of rows with equal `columns` (nulls are equal) in order, from 1. Rows are windowed in chunks of `order`; a row a chunk
    tells the first and last values and how many runs begin after its first row."""
    df = df.withColumn("_k", F.floor(F.col(order) / size)).withColumn("_v", F.struct(*columns))
    w = Window.partitionBy(*by, "_k").orderBy(order)
    df = df.withColumn("_c", F.when(F.row_number().over(w) == 1, 0).otherwise((~F.lag("_v").over(w).eqNullSafe(F.col("_v"))).cast("int")))
    chunks = df.groupBy(*by, "_k").agg(F.min_by("_v", order).alias("_a"), F.max_by("_v", order).alias("_z"), F.sum("_c").alias("_n"))
    at = Window.partitionBy(*by).orderBy("_k")
    new = F.when(F.lag("_z").over(at).eqNullSafe(F.col("_a")) & (F.row_number().over(at) > 1), 0).otherwise(1)
    chunks = chunks.withColumn("_new", new).withColumn("_s", F.sum(F.col("_n") + F.col("_new")).over(at.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    out = df.join(chunks.select(*by, "_k", "_s"), [*by, "_k"])
    return out.withColumn(name, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_s")).drop("_k", "_v", "_c", "_s")


def running(df: DataFrame, by: list[str], order: str, value: str, name: str, size: int = CHUNK, greatest: bool = False) -> DataFrame:
    """Adds the running total of `value` in order, or its running maximum, by chunks of `order` and a table of a row a chunk."""
    whole = F.max if greatest else F.sum
    df = df.withColumn("_k", F.floor(F.col(order) / size))
    sums = df.groupBy(*by, "_k").agg(whole(value).alias("_s"))
    sums = sums.withColumn("_s", whole("_s").over(Window.partitionBy(*by).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)))
    own = whole(value).over(Window.partitionBy(*by, "_k").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    both = F.greatest(own, "_s") if greatest else own + F.coalesce("_s", F.lit(0))
    return df.join(sums, [*by, "_k"]).withColumn(name, both).drop("_k", "_s")


def look_back(df: DataFrame, by: list[str], order: str, value: str, reach: int, name: str, size: int = CHUNK) -> DataFrame:
    """Adds the latest value that isn't null in the `reach` units before a row, the row itself not included. Rows near a chunk's end
    are copied to the next one."""
    own = F.floor(F.col(order) / size)
    both = df.withColumn("_k", F.explode(F.array_distinct(F.array(own, F.floor((F.col(order) + reach) / size))))).withColumn("_own", own)
    w = Window.partitionBy(*by, "_k").orderBy(order).rangeBetween(-reach, -1)
    return both.withColumn(name, F.last(value, True).over(w)).filter("_k = _own").drop("_k", "_own")
