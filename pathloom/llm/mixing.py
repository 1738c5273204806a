"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
#: Documents that one step of the reduction tree rounds together.
FAN_IN = 64
#: Documents of each source and size class, on average, that wait for the last step, so that a large last document finds smaller ones to trade with.
RESERVE = 8
#: Buckets in which rows that repeat a document are numbered.
BUCKETS = 256
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Rows (source, source_size, target) of `sizes` (source, size).

    The targets share the sum of all sizes by weight and stop at `cap` times a source's size; what is over goes to the
    others by weight, until none is above. That is target = min(cap, level * weight) for the one level at which the
    targets add up, found here by ordering sources by cap / weight. One row a source enters the two global windows.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    by = by.withColumn("level", left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the first source in this order that its share doesn't fill sets the level for itself and all after it
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), level * F.col("weight"))
    return by.select("source", "source_size", F.coalesce(target, F.col("cap")).alias("target"))


def _let(value: Column, body) -> Column:
    """Binds `value` once for the expression that `body` makes of it."""
    return F.transform(F.array(value), body)[0]


def _uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


_ITEM = "struct<size:long,doc_id:long,h:long,p:double,base:long,source:string,source_size:long,target:double,rows:long>"
_DONE = "struct<size:long,doc_id:long,h:long,copies:long,source:string,source_size:long,target:double,rows:long>"
_STATE = f"struct<carry:{_ITEM},done:array<{_DONE}>>"


def _done(x: Column, extra: Column) -> Column:
    return F.struct(x["size"].alias("size"), x["doc_id"].alias("doc_id"), x["h"].alias("h"), (x["base"] + extra).alias("copies"), x["source"].alias("source"), x["source_size"].alias("source_size"), x["target"].alias("target"), x["rows"].alias("rows")).cast(_DONE)


def _pivot(state: Column, x: Column) -> Column:
    """One step: the carried document and the next one trade words until the copy number of one is whole.

    a takes d1 words from b, or b takes d2 from a, with chances that leave both expected numbers as they were.
    The sum of probability times size doesn't change.
    """
    a = state["carry"]
    room = lambda y: (1 - y["p"]) * y["size"]
    mass = lambda y: y["p"] * y["size"]
    d = F.struct(room(a).alias("ra"), mass(a).alias("ma"), room(x).alias("rx"), mass(x).alias("mx"))

    def decide(d: Column) -> Column:
        d1, d2 = F.least(d["ra"], d["mx"]), F.least(d["ma"], d["rx"])
        first = _uniform(a["doc_id"], a["h"], x["doc_id"], x["h"]) * (d1 + d2) < d2
        # (is it a that becomes whole, its extra copy, what the other's p becomes)
        to_a = F.when(d["ra"] <= d["mx"], F.struct(F.lit(True).alias("a"), F.lit(1).alias("extra"), (x["p"] - d["ra"] / x["size"]).alias("p"))).otherwise(
            F.struct(F.lit(False).alias("a"), F.lit(0).alias("extra"), (a["p"] + d["mx"] / a["size"]).alias("p"))
        )
        to_x = F.when(d["ma"] <= d["rx"], F.struct(F.lit(True).alias("a"), F.lit(0).alias("extra"), (x["p"] + d["ma"] / x["size"]).alias("p"))).otherwise(
            F.struct(F.lit(False).alias("a"), F.lit(1).alias("extra"), (a["p"] - d["rx"] / a["size"]).alias("p"))
        )
        return F.when(first, to_a).otherwise(to_x)

    def settle(t: Column) -> Column:
        whole, other = F.when(t["a"], a).otherwise(x), F.when(t["a"], x).otherwise(a)
        both = (t["p"] < _EPS) | (t["p"] > 1 - _EPS)
        done = F.concat(state["done"], F.array(_done(whole, t["extra"])), F.when(both, F.array(_done(other, F.round(t["p"]).cast("int")))).otherwise(F.array().cast(f"array<{_DONE}>")))
        carry = F.when(both, F.lit(None).cast(_ITEM)).otherwise(other.withField("p", t["p"]).cast(_ITEM))
        return F.struct(carry.alias("carry"), done.alias("done"))

    traded = _let(_let(d, decide), settle)
    kept = F.struct(x.cast(_ITEM).alias("carry"), state["done"].alias("done"))
    return F.when(a.isNull(), kept).otherwise(traded).cast(_STATE)


def _reduced(items: DataFrame, keys: list[Column]) -> DataFrame:
    """Folds the items of each key, large documents first; columns carry and done."""
    start = F.struct(F.lit(None).cast(_ITEM).alias("carry"), F.array().cast(f"array<{_DONE}>").alias("done")).cast(_STATE)
    grouped = items.groupBy(*keys).agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
    return grouped.select(F.aggregate("items", start, _pivot).alias("state")).select("state.*")


def mix_groups(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, fan_in: int = FAN_IN) -> DataFrame:
    """How often the mix takes each document of `docs` (doc_id, text, source): rows (doc_id, h, size, source, source_size, target, rows, copies).

    Rows that agree in doc_id, text and source are one document of `rows` rows, grouped before they move; `copies` is for all of them. `h`
    is a hash of the text. See mix_plan() for the rounding.
    """
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("h"))
    sizes = sizes.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("rows"))
    base = written(sizes.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * 4)).otherwise(-1)), "mix-sizes")
    classes = base.groupBy("source", "class").agg(F.sum(F.col("size") * F.col("rows")).alias("size"), F.count("*").alias("peers"))
    targets = source_targets(classes, weights, cap).withColumnRenamed("source", "of")
    targets = targets.join(classes.drop("size"), F.col("of").eqNullSafe(F.col("source"))).drop("source").withColumnRenamed("class", "of_class")
    n = base.count()
    wanted = F.when(F.col("size") > 0, F.col("rows") * F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = base.join(targets, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("of_class"))).drop("of", "of_class").withColumn("wanted", wanted)
    # a share within the tolerance of a whole number is that number
    rows = rows.withColumn("base", F.floor(F.col("wanted") + _EPS)).withColumn("p", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0)))
    rows = written(rows, "mix-wanted")
    columns = ["size", "doc_id", "h", "source", "source_size", "target", "rows"]
    parts = [rows.filter(F.col("p") <= _EPS).select(*columns, F.col("base").alias("copies"))]
    item = F.struct("size", "doc_id", "h", "p", "base", "source", "source_size", "target", "rows").cast(_ITEM)
    waits = _uniform(F.lit("reserve"), F.col("doc_id"), F.col("h")) * F.col("peers") < RESERVE
    reserve = rows.filter(F.col("p") > _EPS).filter(waits).select(item.alias("item"))
    cur = rows.filter(F.col("p") > _EPS).filter(~waits).select(item.alias("item"))
    size_class = F.floor(F.log2(F.col("item.size").cast("double")) * 4)
    blocks, level = n, 0
    while True:
        blocks, level = -(-blocks // fan_in), level + 1
        block = F.pmod(F.xxhash64("item.doc_id", "item.h", F.lit(level)), F.lit(max(1, blocks)))
        out = written(_reduced(cur, [F.col("item.source"), size_class, block]), f"mix-level{level}")
        parts.append(out.select(F.explode("done").alias("d")).select("d.*"))
        cur = out.filter(F.col("carry").isNotNull()).select(F.col("carry").alias("item"))
        if blocks <= 1:
            break
    out = written(_reduced(cur.unionByName(reserve), [F.col("item.source")]), "mix-last")
    parts.append(out.select(F.explode("done").alias("d")).select("d.*"))
    last = out.filter(F.col("carry").isNotNull()).select("carry.*")
    parts.append(last.select(*columns, (F.col("base") + F.when(F.col("p") >= 0.5, 1).otherwise(0)).alias("copies")))
    discard(base)
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def _share(number: Column) -> Column:
    """The copies of one of a document's rows, by its number from 0: they differ by one at most, the first ones have more."""
    return F.floor(F.col("copies") / F.col("rows")) + F.when(number < F.col("copies") % F.col("rows"), 1).otherwise(0)


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, fan_in: int = FAN_IN) -> DataFrame:
    """How often the mix takes each row of `docs` (doc_id, text, source): rows (doc_id, h, size, source, source_size, target, copies).

    A source's documents all want target / source_size copies a row. The whole part is given; the fractions are rounded
    dependently: documents of a source and size class, dealt into blocks by a hash of their own, are paired one after
    another, and each pair trades words until one number of copies is whole. A block's one residual goes up a tree of
    `fan_in` until a class has one, the classes of a source, with the few documents of each that were held back, are folded from large
    to small, and the last document rounds to the nearer number. So a source misses its target by half the size of one document at
    most, mostly of a small one.

    No group ever holds a source: blocks are salted by hash, and their number follows the table. Nulls: a null
    source is a source (the last), a null text has size 0, a null doc_id is a document like others. Documents of size 0
    take no words: copies 0. Repeated rows are one document with a copy number each, which differ by one at most; ties are broken by
    hashes. Very long texts are counted whole. Other columns don't matter, whatever their names. An empty table
    gives no rows. Decisions depend on the data alone, so reruns agree. `h` is a hash of the text.
    """
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))
    groups = mix_groups(docs, weights, cap, fan_in).withColumn("number", every)
    return groups.withColumn("copies", _share(F.col("number")).cast("long")).drop("number", "rows")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mixed rows of `docs`, all columns: each row as often as mix_plan() says.

    Where rows that repeat a document can't all have one number of copies, those of the smaller hashes of all their columns have
    more. They are counted in buckets of that hash, and only rows of the one bucket in which the numbers part are ordered.
    """
    groups = mix_groups(docs, weights, cap).filter("copies > 0")
    keys = lambda d, h, s: (F.coalesce(d.cast("long"), F.lit(0)).alias("d"), d.isNull().alias("dn"), h.alias("h"), F.coalesce(s.cast("string"), F.lit("")).alias("s"), s.isNull().alias("sn"))
    names = ["d", "dn", "h", "s", "sn"]
    groups = groups.select(*keys(F.col("doc_id"), F.col("h"), F.col("source")), "rows", "copies")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(whole, *keys(F.col("doc_id"), F.xxhash64("text"), F.col("source")))
    odd = written(groups.filter("copies % rows <> 0"), "mix-uneven")
    even = own.join(groups.filter("copies % rows = 0"), names).withColumn("number", F.lit(0).cast("long"))
    if odd.isEmpty():  # no document has rows that differ in their copies: texts move once
        return _repeated(even, docs)
    uneven = own.join(odd, names)
    # columns of other types than hashes take, such as maps, are hashed as text
    uneven = uneven.withColumn("x", F.xxhash64(F.to_json("row"))).withColumn("bucket", F.pmod("x", F.lit(BUCKETS)))
    counts = uneven.groupBy(*names, "bucket").agg(F.count("*").alias("n"), F.first("copies").alias("copies"), F.first("rows").alias("rows"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("before", before).withColumn("more", F.col("copies") % F.col("rows"))
    place = F.when(F.col("before") + F.col("n") <= F.col("more"), "all").when(F.col("before") >= F.col("more"), "none").otherwise("some")
    uneven = uneven.join(counts.select(*names, "bucket", "before", place.alias("place")), [*names, "bucket"])
    some = F.row_number().over(Window.partitionBy(*names, "bucket").orderBy("x")) - 1 + F.col("before")
    numbered = [
        uneven.filter("place = 'all'").withColumn("number", F.lit(0).cast("long")),
        uneven.filter("place = 'none'").withColumn("number", F.col("rows")),
        uneven.filter("place = 'some'").withColumn("number", some.cast("long")),
    ]
    out = even
    for part in numbered:
        out = out.unionByName(part.select(*even.columns))
    return _repeated(out, docs)


def _repeated(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` out of rows (row, rows, copies, number), each as often as its number says."""
    taken = rows.withColumn("taken", _share(F.col("number")).cast("int")).filter("taken > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("taken"))).alias("i")).select(*[F.col(f"row.`{c}`") for c in docs.columns])
