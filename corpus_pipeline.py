"""A corpus pipeline of five stages over ``documents``, each written as Parquet and read by the next.

Stages take (spark, docs, sf_dir) and return a DataFrame. All but the last keep the columns of
``documents``: rows predicted toxic go, one document stays of each group of near copies, documents that
hold benchmark passages go, secrets are masked; the last packs what is left into token sequences.
Null and empty texts pass the filters (they match nothing) and are packed as one end id. An empty table
gives an empty result. Extra columns of ``documents`` are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import decontamination, ngram_join, packing, queries, secrets, toxicity
from threadloom.llm.scratch import Scratch

#: Words of a shingle, and the similarity in percent from which documents are near copies.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict toxic; it learns from labels that are not held out."""
    queries.prepare(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, queries.table(spark, sf_dir, "labels")))


def _near_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(_gone, _gone_key) of the texts that have a near copy with a smaller doc_id; no key where doc_ids have one text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    key = F.xxhash64("text")
    if texts.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high").isEmpty():
        groups = ngram_join.ngram_components(docs, SHINGLE, PERCENT)
        return groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone"), F.lit(None).cast("long").alias("_gone_key")).distinct()
    # texts share a doc_id: each is linked under a number of its own
    named = scratch.store(texts.dropDuplicates(["doc_id", "text"]).withColumn("id", F.monotonically_increasing_id()), "named")
    groups = ngram_join.ngram_components(named.select(F.col("id").alias("doc_id"), "text"), SHINGLE, PERCENT).select(F.col("doc_id").alias("id"), "component_id")
    placed = scratch.store(named.select("id", F.struct("doc_id", key.alias("key")).alias("text")).join(groups, "id"), "placed")
    first = placed.groupBy("component_id").agg(F.min("text").alias("first"), F.count("*").alias("n")).where("n > 1")
    return placed.join(first, "component_id").where("text <> first").select(F.col("text.doc_id").alias("_gone"), F.col("text.key").alias("_gone_key")).distinct()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of linked documents, and all without links.

    Of rows that repeat a doc_id with equal text one stays; rows without doc_id stay. Different texts with
    one doc_id are judged one by one.
    """
    queries.prepare(spark)
    gone = Scratch(spark, "copies").store(_near_copies(docs, Scratch(spark, "texts")), "gone")
    here = (docs.doc_id.cast("long") == F.col("_gone")) & (F.col("_gone_key").isNull() | (F.xxhash64(docs.text.cast("string")) == F.col("_gone_key")))
    stay = docs.join(gone, here, "left_anti")
    repeated = stay.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1 and doc_id is not null").select("doc_id")
    if repeated.isEmpty():
        return stay
    once = stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return stay.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, short items and changed copies judged by the item's length."""
    queries.prepare(spark)
    return decontamination.clean(docs, queries.table(spark, sf_dir, "benchmark"), by_item=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    queries.prepare(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    queries.prepare(spark)
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaked),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The first stage is a trained classifier and the last a tokenizer's vocabulary: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
