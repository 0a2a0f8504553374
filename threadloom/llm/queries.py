"""Registered queries of the numbered operators: name -> callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import (
    chat, decontamination, filter_audit, licenses, ngram_join, packing, quality_votes, secrets, surrogates, toxicity, vector_dedup, whitening, wrappers)
from threadloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Rows of an Arrow batch; long texts make 10,000 rows too large for a Python worker.
BATCH_ROWS = "1000"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def prepare(spark: SparkSession) -> None:
    """Settings and code that Arrow steps need on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)


def tokenizer_path() -> str:
    """The vocabulary file; installed with the tokenizers on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op6_ngram_jaccard_join(spark, sf):
    return ngram_join.ngram_components(table(spark, sf, "documents"), k=3, percent=90)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op7_pack_tokens(spark, sf):
    return packed(table(spark, sf, "documents"))


@query
def op9_license_scan(spark, sf):
    return licenses.license_report(table(spark, sf, "documents"))


@query
def op3_secret_scan(spark, sf):
    found = secrets.scan_documents(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"))


@query
def op5_decontaminate(spark, sf):
    found = decontamination.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "doc_place", "matched", "score")


@query
def op2_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "guessed_lang")


@query
def op10_vector_near_dedup(spark, sf):
    return vector_dedup.near_vectors(table(spark, sf, "embeddings"), 0.93)


@query
def op8_chat_format(spark, sf):
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.chat_segments(rows))


@query
def op4_main_text(spark, sf):
    texts = wrappers.main_texts(table(spark, sf, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op1_pii_surrogates(spark, sf):
    return surrogates.pseudonymise(table(spark, sf, "documents"), key="registered-query")


@query
def op11_filter_audit(spark, sf):
    return filter_audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_quality_votes(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = quality_votes.score(docs, quality_votes.train(docs, labels))
    return scored.select("doc_id", quality_votes.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op13_whitening(spark, sf):
    return whitening.whitened_components(table(spark, sf, "embeddings"))
