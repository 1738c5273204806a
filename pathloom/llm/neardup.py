"""Near-duplicate documents by b-bit MinHash with exact confirmation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, discard, mix64, salted, sequence_hashes, words_of, written
from .components import connected_components


@dataclass(frozen=True)
class MinHash:
    """Parameters. A pair at the threshold 0.85 shares one of 20 bands of 4 minima but for a chance of 4e-7.

    `width` words make a shingle, `percent` is the least similarity. `minima` values are kept to `bits` low bits each
    for the estimate; `slack` standard deviations below the threshold a candidate is still confirmed exactly. A task compares
    at most `chunk` signatures with as many, and about `set_bytes` of shingle sets with as many.
    """

    width: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 4
    minima: int = 128
    bits: int = 4
    slack: float = 5.0
    chunk: int = 4096
    set_bytes: int = 8 << 20

    @property
    def least_estimate(self) -> float:
        t, c = self.percent / 100, 1 / (1 << self.bits)
        match = t + (1 - t) * c
        return t - self.slack * (match * (1 - match) / self.minima) ** 0.5 / (1 - c)


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; fewer words than `width` make one shingle, none make none."""
    words = words_of(text, lower=True)
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    return np.unique(sequence_hashes(h, min(width, len(h)), seed=min(width, len(h))))


_hashes = WordHashes()


class Signer:
    def __init__(self, p: MinHash):
        self.p = p
        self.factors = mix64(np.arange(1, p.minima + 1, dtype=np.uint64)) | np.uint64(1)

    def minima(self, s: np.ndarray) -> np.ndarray:
        low = np.full(self.p.minima, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 256):  # blocks that stay in the processor's cache
            np.minimum(low, (s[i : i + 256, None] * self.factors).min(0), out=low)
        return low

    def bands(self, low: np.ndarray) -> np.ndarray:
        p = self.p
        keys = sequence_hashes(low[: p.bands * p.rows], p.rows)[:: p.rows]
        return mix64(keys + np.arange(p.bands, dtype=np.uint64)).view(np.int64)

    def packed(self, low: np.ndarray) -> bytes:
        """The low bits of the mixed minima, plane by plane."""
        v = (mix64(low) & np.uint64((1 << self.p.bits) - 1)).astype(np.uint8)
        return b"".join(np.packbits((v >> k) & 1).tobytes() for k in range(self.p.bits))


def estimates(a: np.ndarray, b: np.ndarray, p: MinHash) -> np.ndarray:
    """Collision-corrected similarities of packed signatures (rows of bytes): values that agree in all their bits, counted."""
    planes = (len(a), p.bits, p.minima // 8)
    differ = np.bitwise_or.reduce((a ^ b).reshape(planes), axis=1)
    agree = 1 - np.bitwise_count(differ).sum(1) / p.minima
    c = 1 / (1 << p.bits)
    return (agree - c) / (1 - c)


_SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, packed binary"


def signatures(docs: DataFrame, p: MinHash) -> DataFrame:
    """A row for each row of `docs`: set size, a 128-bit hash of the set, band keys and packed minima."""
    bounded_batches(docs.sparkSession)

    def work(batches):
        signer, empty = Signer(p), np.empty(0, np.int64)
        for batch in batches:
            sizes, f1, f2, bands, packed = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, p.width, _hashes)
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                sizes.append(len(s))
                f1.append((h >> 64) - (1 << 63))
                f2.append((h & (1 << 64) - 1) - (1 << 63))
                low = signer.minima(s) if len(s) else None
                bands.append(signer.bands(low) if len(s) else empty)
                packed.append(signer.packed(low) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                ["doc_id", "n_shingles", "f1", "f2", "bands", "packed"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, _SIGNED)


def _sets(ids: DataFrame, docs: DataFrame, p: MinHash) -> DataFrame:
    """(id, set) of the documents in `ids` (id), made of whole texts anew: sorted hashes as bytes."""
    bounded_batches(docs.sparkSession)

    def make(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, p.width, _hashes).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["id", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids.hint("merge"), "id", "left_semi")
    return texts.mapInArrow(make, "id long, set binary")


class _Unions:
    """Components of small numbers, joined as links are found."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.root[a], self.root[b]
        self.root[self.root == max(x, y)] = min(x, y)


def likely(pairs: DataFrame, classes: DataFrame, p: MinHash) -> DataFrame:
    """Those of `pairs` (a, b) whose signatures let them reach the threshold, with the size of b's set. `a` repeats, `b` doesn't:
    a signature travels once for each b."""

    def judge(batches):
        for batch in batches:
            if len(batch):
                x, y = (np.array([np.frombuffer(x, np.uint8) for x in batch.column(k).to_pylist()]) for k in (3, 4))
                yield pa.RecordBatch.from_arrays(batch.columns[:3], ["a", "b", "n"]).filter(pa.array(estimates(x, y, p) >= p.least_estimate))

    with_b = pairs.join(classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("n"), F.col("packed").alias("y")).hint("merge"), "b")
    hubs = classes.join(pairs.select(F.col("a").alias("id")).distinct().hint("merge"), "id", "left_semi").select(F.col("id").alias("a"), F.col("packed").alias("x"))
    return salted(with_b, hubs, ["a"]).select("a", "b", "n", "x", "y").mapInArrow(judge, "a long, b long, n long")


def confirmed_by_hubs(pairs: DataFrame, sets: DataFrame, p: MinHash) -> DataFrame:
    """Those of `pairs` (a, b, n) whose full sets meet the threshold. The b's of one a are dealt to groups of about p.set_bytes; a's own
    set goes to each."""
    parts = pairs.groupBy("a").agg(F.ceil(F.sum("n") * 8 / p.set_bytes).alias("parts"))
    members = salted(pairs, parts, ["a"]).select(F.col("b").alias("id"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), "parts").alias("part"))
    hubs = parts.select(F.col("a").alias("id"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))

    def judge(table):
        ids, hub = table.column("id").to_numpy(), table.column("hub")[0].as_py()
        each = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        own = [s for i, s in zip(ids, each) if i == hub]
        found = {int(i) for i, s in zip(ids, each) if i != hub and any(_alike(s, o, p) for o in own)}
        return pa.table({"a": pa.array([hub] * len(found), pa.int64()), "b": pa.array(sorted(found), pa.int64())})

    placed = members.unionByName(hubs).join(sets.hint("merge"), "id")
    return placed.groupBy("hub", "part").applyInArrow(judge, "a long, b long")


def _alike(x: np.ndarray, y: np.ndarray, p: MinHash) -> bool:
    """Whether two sorted sets meet the threshold, in whole numbers."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    if not len(small) or 100 * len(small) < p.percent * len(large):
        return False
    at = np.searchsorted(large, small)
    same = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * same >= p.percent * (len(x) + len(y) - same)


def _blocks(members: DataFrame, group: str, weight, most: int) -> DataFrame:
    """Deals the members (group, id, component, ...) of groups that hold several components to blocks (group, i, j).

    The component that weighs most in a group needs no comparison within itself: all others ask. Askers lie in rows of
    blocks, every member in columns, each of about `most` weight. So a group grows by one row a member and block of
    askers, and one with few askers stays linear. Column `asks` tells the two roles of a member apart.
    """
    by = members.groupBy(group, "component").agg(F.sum(weight).alias("w"))
    by = by.groupBy(group).agg(F.count("*").alias("c"), F.sum("w").alias("all"), F.max(F.struct("w", (-F.col("component")).alias("m"))).alias("top")).filter("c > 1")
    by = by.select(group, (-F.col("top.m")).alias("main"), F.ceil((F.col("all") - F.col("top.w")) / most).alias("rows"), F.ceil(F.col("all") / most).alias("columns"))
    dealt = salted(members, by, [group])
    number = lambda c: F.pmod(F.xxhash64("id", F.lit(c)), F.col(c))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    ask = dealt.filter("component != main").withColumn("i", number("rows")).withColumn("j", every("columns")).withColumn("asks", F.lit(True))
    answer = dealt.withColumn("j", number("columns")).withColumn("i", every("rows")).withColumn("asks", F.lit(False))
    return ask.unionByName(answer).drop("main", "rows", "columns")


def likely_components(members: DataFrame, classes: DataFrame, p: MinHash) -> DataFrame:
    """Pairs (a, b) of components that hold members of one band whose signatures let them reach the threshold.

    `members`: (key, id, component). Blocks compare signatures by bit counts; a block gives no pair of components that
    its other pairs already join, so it gives fewer pairs than it has members.
    """

    def compare(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        names, comp = np.unique(table.column("component").to_numpy(), return_inverse=True)
        sig = np.array([np.frombuffer(x, np.uint8) for x in table.column("packed").to_pylist()])
        mine, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        sets, pairs = _Unions(len(names)), []
        for k in mine:
            rest = other[sets.root[comp[other]] != sets.root[comp[k]]]
            if not len(rest):
                continue
            like = estimates(sig[rest], sig[k][None, :], p) >= p.least_estimate
            for c in np.unique(comp[rest[like]]):
                if sets.root[c] != sets.root[comp[k]]:
                    sets.join(c, comp[k])
                    pairs.append((names[c], names[comp[k]]))
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = _blocks(members, "key", F.lit(1), p.chunk).join(classes.select("id", "packed").hint("merge"), "id")
    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def links_between(members: DataFrame, sets: DataFrame, p: MinHash) -> DataFrame:
    """Links (a, b) that join the components of a group wherever two of their members meet the threshold.

    `members`: (family, id, component, n). In a block an asker's shared shingles with all others are counted at once, over an
    index of the block's shingles; a block gives fewer links than it has members.
    """

    def compare(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        names, comp = np.unique(table.column("component").to_numpy(), return_inverse=True)
        each = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        mine, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        sizes = np.array([len(each[o]) for o in other], np.int64)
        entries = np.concatenate([np.empty(0, np.uint64), *[each[o] for o in other]])
        order = np.argsort(entries, kind="stable")
        entries, holder = entries[order], np.repeat(np.arange(len(other)), sizes)[order]
        sets_, a, b = _Unions(len(names)), [], []
        for k in mine:
            root = sets_.root[comp[k]]
            if (sets_.root[comp[other]] == root).all():
                continue
            lo, hi = np.searchsorted(entries, each[k], "left"), np.searchsorted(entries, each[k], "right")
            count = hi - lo
            at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            same = np.bincount(holder[at], minlength=len(other))
            hit = np.flatnonzero((100 * same >= p.percent * (len(each[k]) + sizes - same)) & (sets_.root[comp[other]] != root))
            for o in hit:
                if sets_.root[comp[other[o]]] != sets_.root[comp[k]]:
                    sets_.join(comp[other[o]], comp[k])
                    a.append(ids[k])
                    b.append(ids[other[o]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = _blocks(members, "family", F.col("n") * 8, p.set_bytes).drop("n").join(sets.hint("merge"), "id")
    return dealt.groupBy("family", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, p: MinHash = MinHash()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) for the rows of `docs` (doc_id, text).

    1. Rows with equal shingle sets form a class, known by its smallest doc_id; only classes are compared.
    2. Classes that share a band are candidates. Every class is first compared with one hub, the smallest class of a band
       that it shares, that which most of its bands name: by signature, then by full sets. Links join components.
    3. In bands that still hold several components, signatures are compared in blocks by bit counts; components that a
       passing estimate ties form a family.
    4. Families are compared on full sets, block by block, but for pairs within one component. So every pair that shares a band and
       passes the estimate is joined or has been compared, and no step lays out pairs: blocks give spanning links only.

    Cases: a null or wordless text has the empty set and links with nothing (rows with it don't form a class). A null
    doc_id links with nothing; its component is null and it is kept. Repeated rows are one document and each is
    returned; a doc_id with several texts has the links of all of them. An empty table gives no rows. Ties don't occur:
    components go by the smallest id. Very long texts are hashed whole. Sets are compared as 64-bit hashes. Other columns
    don't matter, whatever their names.
    """
    signed = written(signatures(docs, p), "signatures")
    usable = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    least = usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("doc_id"))
    one_each = usable.dropDuplicates(["doc_id", "f1", "f2"])
    classes = written(one_each.join(least.hint("merge"), ["doc_id", "f1", "f2"]).withColumnRenamed("doc_id", "id"), "classes")
    # a doc_id with several texts ties their classes together
    texts = usable.groupBy("doc_id").agg(F.min(F.struct("f1", "f2")).alias("x"), F.max(F.struct("f1", "f2")).alias("y")).filter("x != y").select("doc_id")
    several = usable.join(texts, "doc_id", "left_semi").join(classes.select("f1", "f2", "id"), ["f1", "f2"]).select("doc_id", "id").distinct()
    several = written(salted(several, several.groupBy("doc_id").agg(F.min("id").alias("a")), ["doc_id"]).select("a", F.col("id").alias("b")), "several")

    bands = classes.select(F.explode("bands").alias("key"), "id")
    hubs = bands.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").select("key", "hub")
    shared = written(salted(bands, hubs, ["key"]), "shared-bands")
    best = shared.filter("id != hub").groupBy("id").agg(F.mode("hub", True).alias("a")).select("a", F.col("id").alias("b"))
    hopeful = written(likely(written(best, "hub-pairs"), classes, p), "likely-pairs")
    sets = written(_sets(shared.select("id").distinct(), docs, p), "shingle-sets")
    links = written(confirmed_by_hubs(hopeful, sets, p).unionByName(several), "hub-links")
    comps = connected_components(links)

    placed = shared.select("key", "id").join(comps.hint("merge"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    ties = written(likely_components(placed, classes, p), "likely-components")
    if not ties.isEmpty():
        families = connected_components(ties).select(F.col("id").alias("component"), F.col("component").alias("family"))
        members = classes.select("id", F.col("n_shingles").alias("n")).join(shared.select("id").distinct().hint("merge"), "id", "left_semi")
        members = members.join(comps.hint("merge"), "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
        more = written(links_between(salted(members, families, ["component"]), sets, p), "family-links")
        comps = connected_components(comps.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(more))
        discard(more)
    # classes that stand for nothing but their one row aren't needed: its component is its own doc_id
    final = classes.select("f1", "f2", "id").join(comps.hint("merge"), "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("component_id"))
    final = written(final, "class-components")
    discard(sets, hopeful, shared, links, several, ties, classes)
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    own = salted(signed.filter(~alone).select("doc_id", "n_shingles", "f1", "f2"), final, ["f1", "f2"]).select("doc_id", "n_shingles", "component_id")
    out = own.unionByName(signed.filter(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
