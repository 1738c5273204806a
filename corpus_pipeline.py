"""A training corpus from `documents`, in stages: toxic documents go, one of each group of near duplicates stays,
repeated passages go, sources are mixed to their weights, and what is left is packed into sequences.

A stage takes the session, the documents its predecessor kept and the folder of the tables; all but the last return the
columns of `documents`. Stages cope with nulls, empty and very long texts, ties, repeated rows and ids, empty tables and columns of clashing
names as their operators say; a doc_id that most rows share is spread over tasks in each of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pathloom.llm import common, mixing, neardup, packing, substrings, toxicity as tox


def toxicity(spark, docs, sf_dir):
    """Drops the documents that the classifier holds for toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return tox.score_toxicity(docs, labels).filter(F.col("predicted") == 0).select(*names)


def _rows_told_apart(docs):
    """`docs` with a column __row: doc_id for the first row of each doc_id, a number above all doc_ids for every further one."""
    several = common.written(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 and doc_id is not null").select("doc_id"), "repeated-ids")
    key = F.col("doc_id").cast("long")
    if several.isEmpty():
        return docs.withColumn("__row", key)
    top = docs.agg(F.max(key)).first()[0]
    # written, for copies must keep their numbers
    again = common.written(docs.join(several, "doc_id", "left_semi").withColumn("__at", F.monotonically_increasing_id()), "repeated-rows")
    first = again.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "__at")).alias("__f")).select(F.col("__f.__at").alias("__at"), F.lit(True).alias("__first"))
    number = F.when(F.col("__first"), key).otherwise(F.lit(top) + 1 + F.col("__at"))
    again = again.join(first, "__at", "left").withColumn("__row", number).drop("__at", "__first")
    return docs.join(several, "doc_id", "left_anti").withColumn("__row", key).unionByName(again)


def near_duplicates(spark, docs, sf_dir):
    """Keeps the document with the smallest doc_id of each group (five-word shingles, similarity 0.8 or more).

    Rows are told apart where they repeat a doc_id: copies are one group, and different texts go or stay each for itself. Of a group's
    rows, those that are the first of their doc_id go before the others.
    """
    rows = _rows_told_apart(docs)
    found = neardup.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("__row")).distinct()
    return rows.join(gone, "__row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark, docs, sf_dir):
    """Takes out passages of 13 words and more that an earlier document holds; n_chars follows the text."""
    out = substrings.remove_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark, docs, sf_dir):
    """Takes documents, some more than once, so that the sources meet their targets."""
    return mixing.mix(docs)


def pack(spark, docs, sf_dir):
    """Cuts and packs the documents; a row for each piece."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
