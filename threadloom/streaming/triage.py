"""Triage of a stream of inquiries against a stored corpus, with an audit log."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.functions.text import is_blank, strip
from threadloom.operators import agent, retrieval
from threadloom.operators.retrieval import VectorIndex
from threadloom.operators.telemetry import telemetry_record


def triage_batch(inquiries: DataFrame, corpus: DataFrame, index: VectorIndex, classes: DataFrame, k: int = 3,
                 **policy) -> DataFrame:
    """Decision records of one batch of inquiries.

    ``inquiries``: query_id, interaction_id, conversation_id, customer_message, timestamp, vector;
    ``corpus``: corpus_id and the case columns; ``index``: their stored vectors; ``classes``: class_id
    (intent), vector. A batch only reads the index.
    Blank messages are rejected before anything is computed for them.
    """
    valid = inquiries.where(~is_blank(F.col("customer_message"))).withColumn(
        "query_context_used", strip(F.col("customer_message")))
    classified = retrieval.zero_shot(valid, classes).select(
        "query_id", F.col("predicted_class").alias("predicted_intent"), F.col("confidence").alias("intent_confidence"))
    payload = corpus.select("corpus_id", *retrieval.CORPUS_COLUMNS)
    hits = retrieval.search(valid, index, k).join(payload, "corpus_id")
    return agent.run(valid, classified, hits, **policy)


def start_triage(inquiries: DataFrame, corpus: DataFrame, index: VectorIndex, classes: DataFrame, path: str, k: int = 3,
                 **policy) -> StreamingQuery:
    """Triage every micro-batch and write its telemetry to ``path``/audit as JSON lines.

    Each batch owns a folder, so a batch that is run again after a failure is not logged twice.
    """
    def handle(batch: DataFrame, number: int) -> None:
        # the share of the batch's time until its records are ready
        began = time.monotonic()
        decided = triage_batch(batch, corpus, index, classes, k, **policy).persist()
        size = decided.count()
        records = decided.withColumn("elapsed_seconds", F.lit((time.monotonic() - began) / max(1, size)))
        telemetry_record(records).write.mode("overwrite").json(f"{path}/audit/batch={number}")
        decided.unpersist()

    return inquiries.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).foreachBatch(handle).start()
