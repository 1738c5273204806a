"""Harmonic packing of documents into training sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import bounded_batches
from .tokens import default_path, encoder

CAPACITY = 2048
#: Remainders are cut at powers of two down to this length; what is shorter stays whole.
SMALLEST_CUT = 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class HarmonicPacker:
    """Packs pieces by reciprocal-capacity class: class k takes lengths in (capacity/(k+1), capacity/k], k of them a bin.

    A document is cut into whole bins, then at powers of two (classes whose bins fill without a gap), then one short
    rest. Each worker fills its own bins, so nothing is shuffled. `rows` of a bin leave when it is full; the open bins
    of a worker hold at most `capacity` ids a class. They are put end to end when the worker's input ends, cut where
    a sequence ends, and the last rest is cut into powers of two, which need no padding.
    """

    def __init__(self, first_id: int, capacity: int = CAPACITY, smallest: int = SMALLEST_CUT):
        self.capacity, self.smallest, self.next_id = capacity, smallest, first_id
        self.open: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while start < total:
            left = total - start
            size = self.capacity if left >= self.capacity else left if left < self.smallest else 1 << left.bit_length() - 1
            # a copy, so that an open bin doesn't keep a whole batch alive
            piece = (doc_id, start, total, ids[start : start + size].astype("<u4"))
            start += size
            k = self.capacity // size
            if k == 1:
                self._close([piece])
                continue
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self._close(self.open.pop(k))

    def finish(self) -> None:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[3]) for p in rest)
        at, pos = 0, 0
        while left:
            room = self.capacity if left >= self.capacity else 1 << left.bit_length() - 1
            left -= room
            bin_ = []
            while room:
                doc_id, start, total, ids = rest[at]
                n = min(room, len(ids) - pos)
                bin_.append((doc_id, start + pos, total, ids[pos : pos + n]))
                room, pos = room - n, pos + n
                if pos == len(ids):
                    at, pos = at + 1, 0
            self._close(bin_)

    def table(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 7
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document of `docs` (doc_id, text; other columns don't matter).

    A null text is an empty one: its only id is the end id. A null doc_id is kept as null. Repeated rows are packed each
    on its own. An empty table gives no row. `sequence_id` is unique over all workers: the partition's number, shifted
    by 40 bits, and a count.
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer or default_path("byte_bpe_50k.json")

    def work(batches):
        packer = HarmonicPacker(TaskContext.get().partitionId() << 40, capacity)
        encode = encoder(path).encode
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                packer.add(doc_id, ids)
            yield packer.table()
        packer.finish()
        yield packer.table()

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(work, SCHEMA)
