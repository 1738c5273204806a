"""Connected components of links between rows, for operators whose groups aren't known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): for every row of `nodes` (node), and every end of `links` (a, b), the smallest node that links lead to.

    Links hang on the smallest neighbour in turns, larger ends first and then smaller ones (the alternating stars of Kiveris et al.,
    2014), until nothing moves; a turn is a stored table, and two aggregates and joins by node.
    """
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    print_ = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = hung.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        now = stored(hung.join(low, "u").select(F.inline(ends)).filter("u <> v").distinct(), "links")
        seen = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())
        if seen == print_:
            break
        print_ = seen
    every = nodes.select("node").unionByName(links.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    return every.join(now.select(F.col("u").alias("node"), F.col("v").alias("_c")), "node", "left").select("node", F.coalesce("_c", "node").alias("component"))
