"""Repeated passages: windows of words that also start in a document with a smaller doc_id are removed.

Difference-cover anchors find the candidates. With cover D of period p, two equal runs of `window` words, wherever they
start, hold words at an offset below p that lie at cover positions in both documents; so a hash of
window - p + 1 words at cover positions only (3 of 7 here) is shared by any two equal windows. Windows around shared
anchors are then compared by hashes of all their words (64 and 32 bits), and consecutive ones make up the passage.

Documents lie in blocks by a hash of doc_id, written once, bucketed, so that the three passes over the texts shuffle none
of them. Blocks send every hash once, however often it occurs in them, and hear only whether it counts; a passage
that most documents hold is one entry a block.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, scratch_path, sequence_hashes, shuffle_partitions, words_of


@dataclass(frozen=True)
class Cover:
    """`offsets` must be a difference cover modulo `period`: every difference modulo it occurs between two of them.

    A block of documents, and a bucket of hashes, holds about `megabytes` of text or hashes, so their numbers follow the table.
    """

    window: int = 13
    period: int = 7
    offsets: tuple[int, ...] = (0, 1, 3)
    megabytes: int = 32

    def __post_init__(self):
        if {(a - b) % self.period for a in self.offsets for b in self.offsets} != set(range(self.period)) or self.window < self.period:
            raise ValueError("not a difference cover for this window")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


_hashes = WordHashes()


def _documents(table: pa.Table, some: set | None = None):
    """(index, doc_id, word hashes) of the rows that have a doc_id, one of `some` if that is given."""
    ids = table.column("doc_id").to_pylist()
    for i, text in enumerate(table.column("text")):
        if ids[i] is not None and (some is None or ids[i] in some):
            yield i, ids[i], _hashes.of(words_of(text.as_py()))


def _anchors(words: np.ndarray, c: Cover) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the cover and the hashes of the anchors that start there."""
    h = sequence_hashes(words, c.anchor, seed=1)
    at = np.flatnonzero(np.isin(np.arange(c.period), c.offsets)[np.arange(len(h)) % c.period])
    return at, h[at]


def _short(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's bucket and 31 further bits; with the bucket they tell anchors apart well enough to find candidates."""
    return (h % np.uint64(n)).astype(np.int64), ((h >> np.uint64(33)).astype(np.int64))


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted distinct keys: the first index of each, the smallest and the largest document."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    last = np.concatenate([first[1:], [len(keys)]]) - 1 if len(keys) else first
    return order[first], docs[first], docs[last]


def _rows(block: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row for each bucket with the bytes of its entries, in the order they stand in."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    ends = np.concatenate([starts[1:], [len(bucket)]]) if len(bucket) else starts
    out = {"block": pa.array(np.full(len(starts), block), pa.int64()), "bucket": pa.array(bucket[starts], pa.int64())}
    for k, c in enumerate(columns):
        out[f"c{k}"] = pa.array([c[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())
    return pa.table(out)


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of bytes, and the number of entries of each row."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return (np.concatenate(parts) if parts else np.empty(0, kind)), np.array([len(p) for p in parts], np.int64)


def _window_keys(words: np.ndarray, c: Cover) -> tuple[np.ndarray, np.ndarray]:
    return sequence_hashes(words, c.window, seed=2), (sequence_hashes(words, c.window, seed=3) >> np.uint64(32)).astype(np.uint32)


def _in(h1: np.ndarray, h2: np.ndarray, known1: np.ndarray, known2: np.ndarray) -> np.ndarray:
    """Which (h1, h2) are among the known ones; known1 ascends and is distinct but for chance."""
    if not len(known1) or not len(h1):
        return np.zeros(len(h1), bool)
    at = np.minimum(np.searchsorted(known1, h1), len(known1) - 1)
    return (known1[at] == h1) & (known2[at] == h2)


_MESSAGE = "block long, bucket long, c0 binary"


def _bucketed(docs: DataFrame, blocks: int, tasks: int) -> DataFrame:
    """The documents in `blocks` blocks, bucketed by block into `tasks` files in the shared folder.

    A row's block follows its doc_id and its place, so that rows that repeat a doc_id lie in many: what is compared are doc_ids, not blocks.
    Only the catalog tells Spark of buckets; once the table is resolved, its entry there is dropped again. The files stay.
    """
    spark = docs.sparkSession
    name = f"pathloom_blocks_{uuid.uuid4().hex}"
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest.alias("rest"), F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(blocks)).alias("block"))
    rows = rows.withColumn("rest", F.col("rest").dropFields(f"r{docs.columns.index('text')}"))
    (rows.repartition(tasks, "block").sortWithinPartitions("block").write.option("compression", "zstd").option("path", scratch_path(spark, "blocks"))
     .bucketBy(tasks, "block").sortBy("block").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def remove_repeats(docs: DataFrame, c: Cover = Cover()) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) with the repeated words taken out of `text`, and the columns n_words,
    n_removed, kept_sha256 (of the kept words joined by blanks) and removed (spans of word numbers, end exclusive), which
    replace columns of the same names.

    A word goes if some window of `c.window` words around it has its word sequence also start in a document with a smaller
    doc_id, judged on the input. A text that loses nothing stays as it is; of others, the kept words are joined by blanks.

    Cases: a null or empty text has no words, and stays as it is. A row without doc_id is neither smaller nor larger than others and stays
    whole. Rows that repeat a doc_id are the same document: they don't remove each other's words. Texts shorter than a
    window lose nothing. An empty table gives no rows. Very long texts are worked on whole, one document at a time. Ties don't occur, for
    rows of one doc_id count as one. All other columns stay as they are, whatever their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = c.megabytes << 20
    tasks = max(shuffle_partitions(spark), -(-size // (4 * most)))
    # a word of six bytes or so gives len(offsets) / period anchors of four
    partitions = max(shuffle_partitions(spark), -(-size * 4 * len(c.offsets) // (6 * c.period * most)))
    blocks = _bucketed(docs, max(2 * tasks, -(-size // most)), tasks)
    texts = blocks.select("block", "doc_id", "text")

    def anchors(key, table):
        found = [(d, _anchors(w, c)[1]) for _, d, w in _documents(table)]
        h = np.concatenate([np.empty(0, np.uint64), *[x for _, x in found]])
        d = np.repeat(np.array([x for x, _ in found], np.int64), [len(x) for _, x in found])
        at, low, high = _least(h, d)
        bucket, short = _short(h[at], partitions)
        # the lowest bit says that two documents of this block hold it
        return _rows(key[0].as_py(), bucket, [(short << 1 | (low != high)).astype(np.uint32)])

    def shared(key, table):
        blocks_of = table.column("block").to_numpy()
        entries, n = _joined(table.column("c0"), np.uint32)
        where = np.repeat(np.arange(len(n)), n)
        value, inverse = np.unique(entries >> 1, return_inverse=True)
        ok = np.bincount(inverse, minlength=len(value)) > 1
        np.logical_or.at(ok, inverse[(entries & 1) == 1], True)
        keep = ok[inverse]
        ends = np.cumsum(np.bincount(where[keep], minlength=len(n)))
        kept = (entries >> 1)[keep]
        out = [kept[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)] if len(n) else []
        return pa.table({"block": pa.array(blocks_of, pa.int64()), "bucket": pa.array(np.full(len(n), key[0].as_py()), pa.int64()), "c0": pa.array(out, pa.binary())})

    def windows(key, table, answer):
        entries, n = _joined(answer.column("c0"), np.uint32)
        known = np.sort(np.repeat(answer.column("bucket").to_numpy(), n) << 31 | entries.astype(np.int64))
        h1s, h2s, ds = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for _, d, w in _documents(table):
            starts = len(w) - c.window + 1
            if starts <= 0 or not len(known):
                continue
            at, h = _anchors(w, c)
            bucket, short = _short(h, partitions)
            mine = bucket << 31 | short
            at = at[known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine]
            # extend: the windows that hold a shared anchor
            edge = np.zeros(starts + 1, np.int64)
            np.add.at(edge, np.clip(at - c.period + 1, 0, starts), 1)
            np.add.at(edge, np.clip(at + 1, 0, starts), -1)
            s = np.flatnonzero(np.cumsum(edge[:-1]))
            if len(s):
                h1, h2 = _window_keys(w, c)
                h1s.append(h1[s])
                h2s.append(h2[s])
                ds.append(np.full(len(s), d, np.int64))
        h1, h2, d = np.concatenate(h1s), np.concatenate(h2s), np.concatenate(ds)
        at, low, _ = _least(h1, d)
        order = np.argsort(low, kind="stable")
        at, low = at[order], low[order]
        sent = _rows(key[0].as_py(), (h1[at] % np.uint64(partitions)).astype(np.int64), [h1[at], h2[at], low])
        # and a note to the block itself: the documents that hold shared anchors; no other can lose words
        block = key[0].as_py()
        note = {"block": pa.array([block], pa.int64()), "bucket": pa.array([-1 - block], pa.int64()), "c0": pa.array([np.unique(d).tobytes()], pa.binary()), "c1": pa.array([b""], pa.binary()), "c2": pa.array([b""], pa.binary())}
        return pa.concat_tables([sent, pa.table(note)])

    def judged(key, table):
        """To each block the windows that start in a smaller document than any of its own; notes pass."""
        if key[0].as_py() < 0:
            return table.select(["block", "bucket", "c0", "c1"])
        h1, n = _joined(table.column("c0"), np.uint64)
        h2, _ = _joined(table.column("c1"), np.uint32)
        low, _ = _joined(table.column("c2"), np.int64)
        where = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((low, h2, h1))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        group = np.cumsum(new) - 1
        late = np.zeros(len(h1), bool)
        late[order] = low[order] > low[order][new][group]
        ends = np.cumsum(np.bincount(where[late], minlength=len(n)))
        cut = list(zip(np.concatenate([[0], ends[:-1]]), ends)) if len(n) else []
        a, b = h1[late], h2[late]
        return pa.table({"block": table.column("block"), "bucket": pa.array(np.full(len(n), key[0].as_py()), pa.int64()), "c0": pa.array([a[i:j].tobytes() for i, j in cut], pa.binary()), "c1": pa.array([b[i:j].tobytes() for i, j in cut], pa.binary())})

    def removed(key, table, answer):
        noted = answer.column("bucket").to_numpy() < 0
        suspects = set(_joined(answer.filter(pa.array(noted)).column("c0"), np.int64)[0].tolist())
        answer = answer.filter(pa.array(~noted))
        known1, _ = _joined(answer.column("c0"), np.uint64)
        known2, _ = _joined(answer.column("c1"), np.uint32)
        order = np.argsort(known1, kind="stable")
        known1, known2 = known1[order], known2[order]
        # windows that two documents of this block share
        found = [(d, _window_keys(w, c)) for _, d, w in _documents(table, suspects)]
        h1 = np.concatenate([np.empty(0, np.uint64), *[k[0] for _, k in found]])
        h2 = np.concatenate([np.empty(0, np.uint32), *[k[1] for _, k in found]])
        d = np.repeat(np.array([x for x, _ in found], np.int64), [len(k[0]) for _, k in found])
        at, low, high = _least(h1, d)
        several = low != high
        own1, own2, own_low = h1[at][several], h2[at][several], low[several]
        late = _in(h1, h2, known1, known2)
        if len(own1):
            spot = np.minimum(np.searchsorted(own1, h1), len(own1) - 1)
            late |= (own1[spot] == h1) & (own2[spot] == h2) & (d > own_low[spot])
        n = len(table)
        sizes, gone, shas, spans, new = np.zeros(n, np.int64), np.zeros(n, np.int64), [], [], []
        numbers = iter(np.split(late, np.cumsum([len(k[0]) for _, k in found])[:-1]) if found else [])
        ids = table.column("doc_id").to_pylist()
        for i, text in enumerate(table.column("text").to_pylist()):
            words = words_of(text)
            sizes[i] = len(words)
            starts = np.flatnonzero(next(numbers)) if ids[i] in suspects else np.empty(0, np.int64)
            runs: list[tuple[int, int]] = []
            if len(starts):
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + c.window, -1)
                cover = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
                turn = np.flatnonzero(cover[1:] != cover[:-1])
                runs = list(zip(turn[::2].tolist(), turn[1::2].tolist()))
                kept, last = [], 0
                for a, b in runs:
                    kept += words[last:a]
                    last = b
                words = kept + words[last:]
                gone[i] = sizes[i] - len(words)
            line = b" ".join(words)
            shas.append(hashlib.sha256(line).hexdigest())
            spans.append([{"start": a, "end": b} for a, b in runs])
            new.append(line.decode("utf-8", "surrogatepass") if runs else text)
        return pa.table({
            "doc_id": table.column("doc_id"), "text": pa.array(new, pa.string()), "n_words": pa.array(sizes), "n_removed": pa.array(gone),
            "kept_sha256": pa.array(shas, pa.string()), "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "rest": table.column("rest"),
        })

    sent = texts.groupBy("block").applyInArrow(anchors, _MESSAGE)
    heard = sent.groupBy("bucket").applyInArrow(shared, _MESSAGE)
    sent = texts.groupBy("block").cogroup(heard.groupBy("block")).applyInArrow(windows, "block long, bucket long, c0 binary, c1 binary, c2 binary")
    heard = sent.groupBy("bucket").applyInArrow(judged, "block long, bucket long, c0 binary, c1 binary")
    rest_type = blocks.schema["rest"].dataType.simpleString()
    out = blocks.groupBy("block").cogroup(heard.groupBy("block")).applyInArrow(removed, f"doc_id long, text string, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>, rest {rest_type}")
    mine = ["n_words", "n_removed", "kept_sha256", "removed"]
    back = [F.col("text") if x == "text" else F.col(f"rest.r{i}").alias(x) for i, x in enumerate(docs.columns) if x not in mine]
    return out.select(*back, *mine)
