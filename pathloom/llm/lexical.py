"""Ranked lexical search: an inverted index by shards of documents, each searched by MaxScore, lists merged in a tree."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, written
from .toplists import TOP, merged, to_lists

#: Digits and lower-case letters stay, A-Z turn, bytes of other characters stay; all other ASCII separates.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Stands for a null doc_id, which comes last among equals.
_NO_ID = (1 << 63) - 1
SHARD = "n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<int>, held array<int>, docs array<int>, tf array<int>"


@dataclass(frozen=True)
class Search:
    """A shard closes at `postings` or `docs`; items are searched in blocks whose texts hold about `megabytes`, which is what every task
    gets of them."""

    k: int = 20
    postings: int = 1 << 19
    docs: int = 65_536
    megabytes: int = 16


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_PLAIN).split(b" ") if text and not text.isspace() else []


class _Builder:
    """Collects documents into a shard; only terms of `vocabulary` are kept, all are counted."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.n_docs = self.n_terms = 0
        self.ids, self.lengths, self.sizes, self.terms, self.tf = [], [], [], [], []

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        counts = Counter(terms_of(text))
        counts.pop(b"", None)
        n = counts.total()
        if not n:
            return
        self.n_docs += 1
        self.n_terms += n
        if hits := self.vocabulary.keys() & counts.keys():
            self.ids.append(_NO_ID if doc_id is None else doc_id)
            self.lengths.append(n)
            self.sizes.append(len(hits))
            self.terms.extend(map(self.vocabulary.__getitem__, hits))
            self.tf.extend(map(counts.__getitem__, hits))

    def close(self) -> pa.RecordBatch:
        term, tf = np.array(self.terms, np.int32), np.array(self.tf, np.int32)
        doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        order = np.argsort(term, kind="stable")
        names, held = np.unique(term, return_counts=True)
        columns = [[x] for x in (self.n_docs, self.n_terms, self.ids, self.lengths, names, held.astype(np.int32), doc[order], tf[order])]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4]
        self._clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in SHARD.split(", ")])


def _shards(docs: DataFrame, vocabulary, p: Search) -> DataFrame:
    def work(batches):
        builder = _Builder(vocabulary.value)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                builder.add(doc_id, text)
                if len(builder.terms) >= p.postings or len(builder.ids) >= p.docs:
                    yield builder.close()
        if builder.n_docs:
            yield builder.close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return written(rows.mapInArrow(work, SHARD), "lexical-shards")


class Shard:
    """A shard with the gain of every posting: what a term adds to a document's score. `best` is a term's largest gain here."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids, lengths, self.terms, held, self.docs, tf = (row[c] for c in ("ids", "lengths", "terms", "held", "docs", "tf"))
        self.ends = np.cumsum(held)
        self.starts = self.ends - held
        m = 75 + (25 * lengths * n_docs) // n_terms
        tf = tf.astype(np.int64)
        self.gain = np.repeat(weights[self.terms], held) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs]))
        self.best = np.maximum.reduceat(self.gain, self.starts) if len(held) else np.empty(0, np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores that hold the shard's `k` best documents of at least `bar` and above 0.

        Lists go from the largest bound down. While the lists left could together lift an unseen document to the bar, they are essential
        and read whole. After that only documents that can still reach the bar are probed for.
        """
        at = np.searchsorted(self.terms, terms)
        there = np.flatnonzero(at < len(self.terms))
        there = there[self.terms[at[there]] == terms[there]]
        at, times = at[there], times[there]
        bounds = self.best[at] * times
        order = np.argsort(-bounds, kind="stable")
        left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # left[j]: what lists from j on can add at most
        score, j = np.zeros(len(self.ids), np.int64), 0
        while j < len(order) and left[j] >= max(bar, 1):
            x = at[order[j]]
            score[self.docs[self.starts[x] : self.ends[x]]] += self.gain[self.starts[x] : self.ends[x]] * times[order[j]]
            j += 1
            if len(score) > k and left[j] < score.max():
                bar = max(bar, int(np.partition(score, -k)[-k]))
        seen = np.flatnonzero((score > 0) & (score + left[j] >= bar))
        score = score[seen]
        for j in range(j, len(order)):
            x = at[order[j]]
            listed = self.docs[self.starts[x] : self.ends[x]]
            place = np.searchsorted(listed, seen)
            place[place == len(listed)] = 0
            hit = listed[place] == seen
            score[hit] += self.gain[self.starts[x] + place[hit]] * times[order[j]]
            if len(score) > k:
                bar = max(bar, int(np.partition(score, -k)[-k]))
                can = score + left[j + 1] >= bar
                seen, score = seen[can], score[can]
        return self.ids[seen], score


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _searched(shards: DataFrame, shared, p: Search) -> DataFrame:
    """Rows (item_id, part, top): a task's best documents of each item. An item's bar rises from shard to shard."""

    def work(batches):
        items, weights, n_docs, n_terms = shared.value
        tops = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].values.to_numpy() for c in ("ids", "lengths", "terms", "held", "docs", "tf")}
                shard = Shard(row, weights, n_docs, n_terms)
                for q, (_, terms, times) in enumerate(items):
                    ids, scores = tops[q]
                    bar = int(scores[-1]) if len(scores) == p.k else 0
                    more = shard.search(terms, times, p.k, bar)
                    tops[q] = _best(np.concatenate([ids, more[0]]), np.concatenate([scores, more[1]]), p.k)
        kept = [(item, *top) for (item, _, _), top in zip(items, tops) if len(top[0])]
        if kept:
            lists = to_lists(np.array([len(t[1]) for t in kept]), np.concatenate([t[2] for t in kept]), np.concatenate([t[1] for t in kept]))
            part = pa.array([TaskContext.get().partitionId()] * len(kept), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in kept], pa.int64()), part, lists], ["item_id", "part", "top"])

    return written(shards.mapInArrow(work, f"item_id long, part long, top {TOP}"), "lexical-lists")


def _block(docs: DataFrame, texts: list[tuple[int | None, bytes]], p: Search) -> DataFrame:
    """The ranks of the items of one block."""
    spark = docs.sparkSession
    counts = [(item, Counter(t for t in terms_of(text) if t)) for item, text in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counts for t in c}))}
    shards = _shards(docs, words := spark.sparkContext.broadcast(vocabulary), p)
    n_docs, n_terms = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    pairs = shards.select(F.explode(F.arrays_zip("terms", "held")).alias("x")).groupBy("x.terms").agg(F.sum("x.held").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2.0)) / (2 * F.col("df") + 1).cast("double")))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, w in pairs.select("terms", weight).collect():  # a row for each term of the block's items
        weights[term] = w
    items = []
    for item, c in counts:
        known = np.array(sorted(vocabulary[t] for t in c), np.int32)
        by = {vocabulary[t]: n for t, n in c.items()}
        items.append((item, known, np.array([by[x] for x in known.tolist()], np.int64)))
    lists = _searched(shards, shared := spark.sparkContext.broadcast((items, weights, n_docs, n_terms)), p)
    parts = lists.agg(F.max("part")).first()[0]
    discard(shards)
    words.unpersist()
    shared.unpersist()
    return merged(lists, "item_id", (parts or 0) + 1, p.k)


def rank(docs: DataFrame, items: DataFrame, p: Search = Search()) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each row of `items` (item_id, text), the `p.k` documents of `docs` (doc_id, text) of the
    highest score above 0, ties by ascending doc_id. All documents and whole texts count, in the statistics too.

    Texts are cut into terms once a block of items and kept as shards with an inverted index of the items' terms. A task searches its
    shards one by one; its lists are merged in a tree.

    Cases: null and empty texts hold no term; documents without terms aren't counted. Rows that repeat a doc_id are documents of their own.
    A null doc_id comes last among equals. Of rows that repeat an item_id the greatest text counts; a null item_id is one too. Items
    without terms, or whose terms no document holds, give no rows. A text is one document however long. Other columns don't matter, whatever
    their names.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).groupBy("item_id").agg(F.max("text").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0]
    out = spark.createDataFrame([], "item_id long, rank int, id long, score long")
    blocks = -(-(size or 0) // (p.megabytes << 20))
    for b in range(blocks):
        texts = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).select("item_id", F.col("text").cast("binary")).collect()
        if texts:
            out = out.unionByName(_block(docs, [(r[0], bytes(r[1]) if r[1] is not None else None) for r in texts], p))
    return out.select("item_id", "rank", F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "score")
