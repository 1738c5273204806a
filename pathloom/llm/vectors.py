"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _vector(df: DataFrame, vec_col: str) -> Column:
    """The vectors as they travel: single precision stays so, for it holds what the table holds; all else becomes double."""
    return F.col(vec_col).cast("array<float>" if isinstance(df.schema[vec_col].dataType.elementType, T.FloatType) else "array<double>")


def takes_part(v: Column) -> Column:
    """Whether a vector is neither null nor zero and all finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(v.isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (id, vec) whose id isn't null and whose vector takes part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), _vector(df, vec_col).alias("vec"))
    return rows.filter(F.col("id").isNotNull() & takes_part(F.col("vec")))


def unusable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """The ids (null too) of the other rows."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), _vector(df, vec_col).alias("vec"))
    return rows.filter(F.col("id").isNull() | ~takes_part(F.col("vec"))).select("id")


def matrix(column) -> np.ndarray:
    """A list column of numbers, all of one length, as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 1)
