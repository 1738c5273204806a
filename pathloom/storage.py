"""Tables that operators of several passes keep between them, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_paths: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local master may leave it unset; it gets a temporary one."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="pathloom-")
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: it is computed once, its rows keep what numbers they have, and a lost executor costs
    no more than a reread."""
    _paths.append(f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(_paths[-1])
    return df.sparkSession.read.schema(df.schema).parquet(_paths[-1])


def sweep(spark: SparkSession) -> int:
    """Delete what the operators of this process have stored, once their results have been used; gives the number of tables."""
    for path in _paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    n = len(_paths)
    _paths.clear()
    return n
