"""Telemetry projection and summaries, shared by the batch and streaming forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.numbers import round_even

# Upper bounds of the confidence histogram.
BOUNDS = {"0.5": 0.5, "0.75": 0.75, "0.9": 0.9}


def telemetry_record(records: DataFrame, provider_mode: str = "mock") -> DataFrame:
    """The nine non-sensitive fields of a decision record, latency in milliseconds."""
    return records.select(
        "interaction_id", "timestamp",
        F.coalesce("decision", F.lit("AUTO")).alias("decision"),
        F.coalesce("escalation_reason", F.lit("none")).alias("escalation_reason"),
        "predicted_intent",
        F.coalesce("intent_confidence", F.lit(0.0)).cast("double").alias("intent_confidence"),
        F.coalesce("retrieval_similarity", F.lit(0.0)).cast("double").alias("retrieval_similarity"),
        round_even(F.coalesce("elapsed_seconds", F.lit(0.0)).cast("double") * 1000.0, 2).alias("latency_ms"),
        F.lit(provider_mode).alias("provider_mode"))


def counters() -> list[Column]:
    """Aggregates of the running totals."""
    auto = F.col("decision") == "AUTO"
    return [F.count("*").alias("total_inquiries"), F.count_if(auto).alias("auto_handled"),
            F.count_if(~auto).alias("escalated"), F.sum("intent_confidence").alias("confidence_sum")]


def with_rates(totals: DataFrame) -> DataFrame:
    def per_inquiry(name: str) -> Column:
        # nine digits first: a floating-point sum depends on the order of its parts beyond that
        share = round_even(F.round(F.col(name).cast("double"), 9) / F.nullif("total_inquiries", F.lit(0)), 4)
        return F.coalesce(share, F.lit(0.0))

    return totals.withColumn("escalation_rate", per_inquiry("escalated")).withColumn(
        "mean_intent_confidence", per_inquiry("confidence_sum")).drop("confidence_sum")


def telemetry_summary(events: DataFrame) -> DataFrame:
    """One row: totals, rates and a JSON map of reason counts over escalated inquiries."""
    # reasons are counted first; the seven-value enum bounds the map
    per_reason = events.groupBy("decision", "escalation_reason").agg(
        F.count("*").alias("n"), F.sum("intent_confidence").alias("confidence"))
    auto = F.col("decision") == "AUTO"
    n = F.col("n")
    by_reason = per_reason.groupBy(F.when(~auto, F.col("escalation_reason")).alias("reason")).agg(
        F.sum("n").alias("n"), F.sum("confidence").alias("confidence"),
        F.sum(F.when(auto, n).otherwise(0)).alias("auto"))
    entry = F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))
    totals = by_reason.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_inquiries"),
        F.coalesce(F.sum("auto"), F.lit(0)).alias("auto_handled"),
        F.coalesce(F.sum(F.col("n") - F.col("auto")), F.lit(0)).alias("escalated"),
        F.sum("confidence").alias("confidence_sum"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("escalation_reasons"))
    return with_rates(totals)


def histogram() -> list[Column]:
    """Cumulative bucket counts, evidence total and per-action counts."""
    confidence = F.col("intent_confidence")
    return [
        *[F.count_if(confidence <= bound).alias("le_" + name.replace(".", "_")) for name, bound in BOUNDS.items()],
        F.count("*").alias("le_inf"),
        F.coalesce(F.sum("evidence_count"), F.lit(0)).alias("evidence_items"),
        F.count_if(F.upper("decision") == "AUTO").alias("auto_count"),
        F.count_if(F.upper("decision") == "ESCALATE").alias("escalate_count"),
    ]


def confidence_histogram(events: DataFrame) -> DataFrame:
    row = events.agg(*histogram())
    return row.unpivot([], row.columns, "metric", "n")


def reason_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("decision", "escalation_reason").agg(F.count("*").alias("n"))


def windowed_totals(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Totals and histogram per tumbling event-time window; the stream runs the same expression."""
    grouped = events.groupBy(F.window("ts", width).alias("w")).agg(*counters(), *histogram())
    return with_rates(grouped).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "*").drop("w")
