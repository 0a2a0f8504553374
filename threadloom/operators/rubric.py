"""Rubric scores by rule, ingest of external scores, and variant means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.schemas import RUBRIC

SCORES = ["correctness", "groundedness", "helpfulness", "policy_safety"]


def score_reply(reply: Column) -> dict[str, Column]:
    """The four 0-2 rule scores of a reply text."""
    low = F.lower(reply)

    def two_if(condition: Column, other: int = 1) -> Column:
        return F.when(condition, 2).otherwise(other)

    return {
        "correctness": two_if(F.length(reply) > 10),
        "groundedness": two_if(low.contains("dm") | low.contains("detail")),
        "helpfulness": two_if(low.contains("please") | low.contains("dm")),
        "policy_safety": two_if(~(low.contains("refund") & low.contains("free")), 0),
    }


def with_total(df: DataFrame) -> DataFrame:
    """The total is always the sum of the parts."""
    return df.withColumn("total_score", sum((F.col(s) for s in SCORES[1:]), F.col(SCORES[0])))


def score_replies(df: DataFrame, reply: str) -> DataFrame:
    scored = score_reply(F.coalesce(reply, F.lit("")))
    return with_total(df.select("*", *[scored[s].alias(s) for s in SCORES]))


def ingest_scores(df: DataFrame, payload: str) -> DataFrame:
    """Scores from JSON text: clamped to 0-2, 1 when missing, total recomputed."""
    parsed = df.withColumn("r", F.from_json(payload, RUBRIC))
    clamp = [F.least(F.greatest(F.coalesce(f"r.{s}", F.lit(1)), F.lit(0)), F.lit(2)).alias(s) for s in SCORES]
    rationale = F.coalesce("r.rationale", F.lit("No rationale provided.")).alias("rationale")
    return with_total(parsed.select("*", *clamp, rationale).drop("r"))


def variant_means(scored: DataFrame, variant: str = "variant") -> DataFrame:
    return scored.groupBy(variant).agg(
        F.count("*").alias("n"), *[F.round(F.avg(s), 6).alias(s) for s in [*SCORES, "total_score"]])
