"""Labelled vectors compared with all the others of their table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import bhattacharyya_similarity
from ..session import ship


def _unit(vec: str) -> Column:
    v = F.col(vec).cast("array<double>")
    # the length is a variable of the last step, so that it isn't computed anew for each component
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x, lambda s: F.transform(v, lambda x: x / F.sqrt(s)))


def _units(df: DataFrame, id_col: str, vec: str, label: str) -> DataFrame:
    """Rows (id, label, u) of the vectors that have a direction."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), _unit(vec).alias("u")).filter("id is not null and u is not null")
    return rows.filter(F.forall("u", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def nearest_labels(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, megabytes: int = 16, least: int = 4) -> DataFrame:
    """Rows (id, label, ranked): the labels of the k nearest by cosine of all other vectors, best first, ties by the smaller id.

    Every block of vectors is compared with every other one, and only the k best of each block are sent on. Ids are unique;
    vectors that are null, zero or not finite take no part.
    """
    spark = df.sparkSession
    ship(spark)
    rows = _units(df, id_col, vec, label)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("u")).alias("d")).first()
    blocks = max(least, -(-size["n"] // max(1, (megabytes << 20) // (8 * (size["d"] or 1)))))
    every, own = F.sequence(F.lit(0), F.lit(blocks - 1)), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    asked = rows.select(F.explode(every).alias("j"), own.alias("i"), F.lit(True).alias("ask"), "id", "u")
    held = rows.select(own.alias("j"), F.explode(every).alias("i"), F.lit(False).alias("ask"), "id", "u")

    def best(table):
        table = table.sort_by("id")
        ask, ids, flat = table.column("ask").to_numpy(), table.column("id").to_numpy(), table.column("u").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        left, right = np.flatnonzero(ask), np.flatnonzero(~ask)
        y, refs, out = x[right], ids[right], ([], [], [])
        step = max(1, (2 << 20) // max(1, len(right)))
        for s in range(0, len(left) if len(right) else 0, step):
            part = left[s : s + step]
            score = x[part] @ y.T
            score[ids[part][:, None] == refs[None, :]] = -np.inf
            m = min(k, len(refs))
            floor = np.partition(score, -m, axis=1)[:, -m] - 1e-9
            for q, near, low in zip(part, score, floor):
                c = np.flatnonzero((near >= low) & np.isfinite(near))
                exact = (y[c] * x[q]).sum(1)  # one formula, so that equal vectors tie
                c, exact = (z[np.lexsort((refs[c], -exact))[:k]] for z in (c, exact))
                for column, values in zip(out, (np.full(len(c), ids[q]), refs[c], exact)):
                    column.append(values)
        return pa.table({name: pa.array(np.concatenate(z) if z else [], kind) for name, kind, z in zip(("id", "ref", "s"), (pa.int64(), pa.int64(), pa.float64()), out)})

    found = asked.unionByName(held).repartition(min(blocks * blocks, 2000), "i", "j").groupBy("i", "j").applyInArrow(best, "id long, ref long, s double")
    order = Window.partitionBy("id").orderBy(F.desc("s"), "ref")
    found = found.withColumn("p", F.row_number().over(order)).filter(F.col("p") <= k)
    named = found.join(rows.select(F.col("id").alias("ref"), F.col("label").alias("guess")), "ref")
    ranked = named.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "guess"))), lambda g: g["guess"]).alias("ranked"))
    return rows.select("id", "label").join(ranked, "id")


def _beside_each(rows: DataFrame, id_col: str, refs: DataFrame, team: str, size: int, held: int) -> DataFrame:
    """Every row beside every reference; `size` is the references' bytes.

    Up to `held` bytes of references go to every task. More are dealt into blocks of about `held` bytes, which rows meet in a shuffled
    join, salted so that the rows of a block are many tasks' work.
    """
    blocks = -(-size // held)
    if blocks <= 1:
        return rows.crossJoin(F.broadcast(refs))
    salts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")).withColumn("_block", every(blocks))
    right = refs.withColumn("_block", F.pmod(F.xxhash64(team), F.lit(blocks)).cast("int")).withColumn("_salt", every(salts))
    return left.join(right, ["_block", "_salt"]).drop("_block", "_salt")


def mean_similarity(df: DataFrame, id_col: str, vec: str, label: str, held: int = 64 << 20) -> DataFrame:
    """Rows (id, label, team, score): the mean cosine of each vector with all vectors of each label but itself.

    The mean of cosines is the product with the mean of unit vectors, so a label is one row; labels of more than `held` bytes aren't sent
    to every task. Ids are unique; vectors that are null, zero or not finite take no part, nor does a label that only the vector itself has.
    """
    rows = _units(df, id_col, vec, label)
    size = rows.agg(F.count_distinct("label").alias("n"), F.max(F.size("u")).alias("d")).first()
    sums = rows.select("label", F.posexplode("u").alias("at", "x")).groupBy("label", "at").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    sums = sums.groupBy(F.col("label").alias("team")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("t"), F.max("n").alias("n"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    own = F.col("label").eqNullSafe(F.col("team")).cast("int")
    both = _beside_each(rows, "id", sums, "team", 8 * (size["n"] + 1) * (size["d"] or 0), held).withColumn("others", F.col("n") - own).filter("others > 0")
    return both.select("id", "label", "team", ((dot("t", "u") - own * dot("u", "u")) / F.col("others")).alias("score"))


def team_histograms(df: DataFrame, team: str, hist: str) -> DataFrame:
    """(team, histogram): the mean of a team's histograms, place by place."""
    places = df.select(F.col(team).alias("team"), F.posexplode(hist).alias("at", "x")).groupBy("team", "at").agg(F.avg("x").alias("x"))
    return places.groupBy("team").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("histogram"))


def match_histograms(df: DataFrame, id_col: str, hist: str, refs: DataFrame, held: int = 64 << 20) -> DataFrame:
    """(id, team, similarity): the team of `refs` (team, histogram) whose histogram is most alike; ties go to the smaller team.

    team is null where no reference can be compared: an empty, zero or null histogram; without references there are no rows. Ids are unique.
    """
    size = refs.agg(F.sum(8 * F.greatest(F.size("histogram"), F.lit(0)))).first()[0] or 0
    rows = df.select(F.col(id_col).alias("id"), F.col(hist).alias("p"))
    alike = bhattacharyya_similarity(F.col("p"), F.col("histogram"))
    found = _beside_each(rows, "id", refs.select("team", "histogram"), "team", size, held).withColumn("s", alike)
    best = found.groupBy("id").agg(F.min(F.when(F.col("s").isNotNull() & ~F.isnan("s"), F.struct((-F.col("s")).alias("s"), "team"))).alias("b"))
    return best.select("id", "b.team", (-F.col("b.s")).alias("similarity"))
