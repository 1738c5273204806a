"""Places of rows in an order, over any number of rows and groups of any size, without a task that holds a whole group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import stored


def _summed(value: str):
    """For mapInArrow: adds __sum, the total of the whole numbers in `value` of the rows before in the task, nulls as 0."""

    def work(batches):
        done = 0
        for batch in batches:
            v = pc.fill_null(batch.column(value), 0).to_numpy(zero_copy_only=False)
            total = done + np.cumsum(v)
            done = int(total[-1]) if len(v) else done
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total - v, pa.int64())], [*batch.schema.names, "__sum"])

    return work


def numbered(df: DataFrame, by: list[str], order: list, name: str = "pos", total: tuple[str, str] | None = None) -> DataFrame:
    """Adds `name`: a row's place, from 0, in its group by `order` (names or columns); which of equal rows comes first is arbitrary, but fixed.
    With `total`, a column of long and a name, also the sum of that column up to the row, itself included, nulls as 0.

    Ranges of all rows, by group and order, are sorted apart and stored; a row for each group in each range says how many come before. Ranges are
    about as many as partitions, and a hot group lies in many of them. Groups whose key is null are groups too.
    """
    keys = [F.col(c) for c in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    if total:
        ranged = ranged.mapInArrow(_summed(total[0]), T.StructType([*ranged.schema.fields, T.StructField("__sum", T.LongType())]))
    # the id is the range's number, above 33 bits for the row's place in it
    ranged = stored(ranged, "ranges").withColumn("__g", F.struct(F.lit(0), *by)).withColumn("__part", F.shiftright("__at", 33)).withColumn("__row", F.col("__at").bitwiseAND((1 << 33) - 1))
    sums = [F.min_by("__sum", "__row").alias("__less"), F.sum(total[0]).alias("__t")] if total else []
    starts = ranged.groupBy("__g", "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"), *sums)
    earlier = Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    more = [(before("__t") - F.col("__less")).alias("__add")] if total else []
    starts = starts.select("__g", "__part", (before("__n") - F.col("__first")).alias("__skip"), *more)
    out = ranged.join(starts, ["__g", "__part"]).withColumn(name, F.col("__row") + F.col("__skip"))
    if total:
        out = out.withColumn(total[1], F.col("__sum") + F.coalesce(total[0], F.lit(0)) + F.col("__add"))
    return out.select(*df.columns, name, *([total[1]] if total else []))
