"""What the operators share: the scratch folder, Arrow batch limits, words and hashes."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Rows and bytes of an Arrow batch handed to a Python worker at once.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may leave it unset; it gets a temporary one."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="pathloom-")
        sc.setCheckpointDir(where)
    return where.rstrip("/")


_paths: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    _paths.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _paths[-1]


def sweep(spark: SparkSession) -> int:
    """Delete whatever the operators of this process have left in the shared folder, once their results have been stored or used; gives
    the number of paths."""
    for path in _paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    n = len(_paths)
    _paths.clear()
    return n


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: lineage ends here, and a lost executor costs no more than a reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` made and that no later plan reads."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def salted(left: DataFrame, right: DataFrame, on: list[str], salts: int = 8) -> DataFrame:
    """Inner join in which the rows of a key lie in `salts` tasks: left rows go to one by a hash of all they hold, the rows of
    `right`, few a key, go to each."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right.hint("merge"), [*on, "_salt"]).drop("_salt")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for workers that share an executor with long documents, and let workers import us."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to `limit` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as UTF-8; bytes.split() cuts at exactly these six characters, lower() turns A-Z."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (the public 64-bit one of MurmurHash3) that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def sequence_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of `width` words, from the words' own hashes; order counts."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, seed + 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for k in range(width):
        out = (out ^ words[k : k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix64(out)
