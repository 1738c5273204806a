"""Merging of top lists that many tasks made for the same keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry orders by its negated score, then by id, so that the natural order of structs is best first.
TOP = "array<struct<neg: long, id: long>>"


def to_lists(counts: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    """Lists of so many entries each, from flat scores and ids."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(-scores, pa.int64()), pa.array(ids, pa.int64())], ["neg", "id"])
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def merged(lists: DataFrame, key: str, parts: int, k: int, fan: int = 16) -> DataFrame:
    """Rows (`key`, rank, id, score) from rows (`key`, part, top): a tree whose nodes merge the lists of `fan` parts, `k` entries a list.

    No node holds more than `fan` lists, however many parts there are; a part gives a key one list at most."""
    while parts > 1:
        both = F.array_sort(F.flatten(F.collect_list("top")))
        lists = lists.groupBy(key, F.expr(f"part div {fan}").alias("part")).agg(F.slice(both, 1, k).alias("top"))
        parts = -(-parts // fan)
    each = lists.select(key, F.posexplode("top").alias("at", "entry"))
    return each.select(key, (F.col("at") + 1).cast("int").alias("rank"), F.col("entry.id").alias("id"), (-F.col("entry.neg")).alias("score"))
