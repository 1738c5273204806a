"""Connected components of a link table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, salted, written


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in `links` (a, b): the smallest id reachable.

    Alternates the large-star and small-star steps of the published algorithm (Kiveris et al., 2014) until a
    round changes nothing, however many it takes; each round is written to the shared folder and the one before it deleted.
    A node with very many links costs one grouped minimum, combined before the shuffle, and a salted join. Null ends are ignored.
    """
    links = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    cur = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc0")
    mark, i = None, 0
    while True:
        i += 1
        # large star: every larger neighbour of u hangs on the smallest of u and its neighbours
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        new = salted(both.filter(F.col("v") > F.col("u")), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours hang on the smallest of them
        low = new.groupBy("u").agg(F.min("v").alias("m"))
        new = salted(new, low, ["u"]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        last, cur = cur, written(new.filter(F.col("u") != F.col("v")).distinct(), f"cc{i}")
        discard(last)
        now = tuple(cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == mark:
            break
        mark = now
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
