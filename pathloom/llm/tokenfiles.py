"""Token files: concatenated ids with Elias-Fano coded document boundaries.

A file holds, little-endian: the magic b"PLTF2\\0", the width of an id in bytes (2 or 4) and 0, then as int64 the number
of documents, of ids and of leading documents without a doc_id and the byte lengths of two Elias-Fano sequences, then the
sequences (where each document ends; the doc_ids), then the ids. A sequence has, besides its bits, a directory of where every 256th value's
high bits lie. Offsets are found by select through it, at about 2.5 + log2(ids / documents) bits a document; nothing
of a file's bounds is decoded beyond the 256 values about those asked for.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, scratch_path, written
from .tokens import default_path, encoder

MAGIC = b"PLTF2\0"
#: Documents whose bounds a reader holds at once.
READ = 4096
#: Ids in a file, at which a writer begins the next one.
FILE_IDS = 4_000_000


class EliasFano:
    """A non-decreasing sequence of integers >= 0: low bits packed, high bits in unary, with select by a stored directory."""

    SAMPLE = 256

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, at: np.ndarray, before: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        #: For every SAMPLE-th one, the byte that holds it; ones before that byte.
        self.at, self.before = at, before

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        places = (values >> low_bits) + np.arange(n)
        marks = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        marks[places] = 1
        high = np.packbits(marks, bitorder="little")
        at = places[:: cls.SAMPLE] >> 3
        before = np.searchsorted(places, at << 3)
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"), high, at, before)

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqqqq", self.n, self.low_bits, len(self.low), len(self.high), len(self.at))
        return head + self.at.astype("<i8").tobytes() + self.before.astype("<i8").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, a, b, m = struct.unpack_from("<qqqqq", data)
        low = 40 + 16 * m
        return cls(n, low_bits, np.frombuffer(data, np.uint8, a, low), np.frombuffer(data, np.uint8, b, low + a), np.frombuffer(data, "<i8", m, 40), np.frombuffer(data, "<i8", m, 40 + 8 * m))

    def values(self, a: int, b: int) -> np.ndarray:
        """The values a to b - 1, from the directory's entry before the first to that after the last."""
        if a >= b:
            return np.empty(0, np.int64)
        j, k = a // self.SAMPLE, -(-b // self.SAMPLE)
        first, last = int(self.at[j]), int(self.at[k]) + 1 if k < len(self.at) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
        high = ones[a - int(self.before[j]) : b - int(self.before[j])] - np.arange(a, b)
        start, end = a * self.low_bits, b * self.low_bits
        bits = np.unpackbits(self.low[start >> 3 : -(-end >> 3) if end else 0], bitorder="little")[start & 7 :][: end - start].reshape(b - a, self.low_bits)
        return (high << self.low_bits) | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1, dtype=np.int64)

    def all(self) -> np.ndarray:
        return self.values(0, self.n)

    def select(self, i: int) -> int:
        """The i-th value."""
        return int(self.values(i, i + 1)[0])


def encode_file(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """doc_ids ascend, those that are None first."""
    nulls = sum(d is None for d in doc_ids)
    base = min((d for d in doc_ids[nulls:]), default=0)
    ends = EliasFano.of(np.cumsum([len(d) for d in docs])).to_bytes()
    names = EliasFano.of(np.array([d - base for d in doc_ids[nulls:]], np.int64)).to_bytes()
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint32)
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = struct.pack("<BBqqqqqq", width, 0, len(doc_ids), len(ids), nulls, base, len(ends), len(names))
    return MAGIC + head + ends + names + ids.astype(f"<u{width}").tobytes()


class TokenFile:
    """A decoded file: `ends`, `names`, `ids`; document i is self[i]."""

    def __init__(self, data: bytes):
        if data[:6] != MAGIC:
            raise ValueError("not a token file")
        width, _, self.n, _, self.nulls, self.base, a, b = struct.unpack_from("<BBqqqqqq", data, 6)
        at = 6 + struct.calcsize("<BBqqqqqq")
        self.ends, self.names = EliasFano.from_bytes(data[at : at + a]), EliasFano.from_bytes(data[at + a : at + a + b])
        self.ids = np.frombuffer(data, f"<u{width}", offset=at + a + b)

    def bounds(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def __getitem__(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.ids[a:b]

    def doc_ids(self, a: int = 0, b: int | None = None) -> list[int | None]:
        """Those of the documents a to b - 1."""
        b = self.n if b is None else b
        named = self.names.values(max(0, a - self.nulls), max(0, b - self.nulls)) + self.base
        return [None] * (min(b, self.nulls) - min(a, self.nulls)) + named.tolist()


def _put(folder: str, name: str, data: bytes) -> None:
    """Writes under another name and renames, so a lost or repeated attempt leaves a whole file or none."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    part = posixpath.join(path, f"_{name}.{uuid.uuid4().hex}")
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, posixpath.join(path, name))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of `docs` (doc_id, text) in ascending doc_id order below `folder`; returns a row for each file.

    Nulls: a null text is an empty one, null doc_ids come first. Rows that repeat a doc_id are each written, ordered by
    their texts' first 64 characters, then hashes. One shuffle, by ranges of all that, so a doc_id with any share of the rows lies in many;
    nothing else moves. A very long text is encoded whole and lies in one file. An empty table gives no file. Other columns don't matter, whatever
    their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = tokenizer or default_path("word_bpe_49k.json")

    def work(batches):
        part, names, ids, count, seq = TaskContext.get().partitionId(), [], [], 0, 0

        def flush():
            nonlocal names, ids, count, seq
            name = f"part-{part:08d}-{seq:06d}.bin"
            _put(folder, name, encode_file(names, ids))
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "name": name, "n_docs": len(names), "n_ids": count}])
            names, ids, count, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist())):
                names.append(d)
                ids.append(x.astype(np.uint16) if x.max() < 1 << 16 else x)
                count += len(x)
                if count >= file_ids:
                    yield flush()
        if names:
            yield flush()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], F.left("text", F.lit(64)).alias("opening"), F.xxhash64("text").alias("h"))
    # ranges are drawn from a sample of these columns, which whole texts would make large; the last one parts equal rows
    order = ["doc_id", "opening", "h", "place"]
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = written(rows.mapInArrow(work, "part long, seq long, name string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file, not document
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read from the files that `files` lists."""
    spark = files.sparkSession

    def work(batches):
        for batch in batches:
            for first, data in zip(batch.column("first_id").to_pylist(), batch.column("content")):
                f, start = TokenFile(data.as_buffer()), 0
                for i in range(0, f.n, READ):
                    j = min(f.n, i + READ)
                    ends = f.ends.values(i, j)
                    starts = np.concatenate([[start], ends[:-1]]).astype(np.int64)
                    start = int(ends[-1])
                    crc = [zlib.crc32(f.ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids(i, j), pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    blobs = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.bin").load(folder)
    blobs = blobs.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    named = files.select("name", "first_id")
    # a row of 40 bytes for each file of millions of ids; beyond the bound Spark chooses the join
    joined = blobs.join(F.broadcast(named) if named.count() <= 200_000 else named, "name")
    return joined.select("first_id", "content").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize_to_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes token files into the shared folder and reads them back. An empty table gives no file and no row."""
    folder = scratch_path(docs.sparkSession, "tokens")
    files = write_tokens(docs, folder, tokenizer)
    if files.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_tokens(files, folder)
