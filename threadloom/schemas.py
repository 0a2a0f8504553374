"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T

TWEET_SOURCE = T.StructType([
    T.StructField("tweet_id", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("response_tweet_id", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.StringType()),
])

TELEMETRY = T.StructType([
    T.StructField("interaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("escalation_reason", T.StringType()),
    T.StructField("predicted_intent", T.StringType()),
    T.StructField("intent_confidence", T.DoubleType()),
    T.StructField("retrieval_similarity", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("provider_mode", T.StringType()),
])

TAXONOMY = T.StructType([
    T.StructField("intent_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("inclusion_criteria", T.ArrayType(T.StringType())),
    T.StructField("exclusion_criteria", T.ArrayType(T.StringType())),
    T.StructField("default_risk", T.StringType()),
    T.StructField("examples", T.ArrayType(T.StringType())),
])

RUBRIC = T.StructType([
    T.StructField("correctness", T.IntegerType()),
    T.StructField("groundedness", T.IntegerType()),
    T.StructField("helpfulness", T.IntegerType()),
    T.StructField("policy_safety", T.IntegerType()),
    T.StructField("rationale", T.StringType()),
])

INTERACTION_COLUMNS = [
    "interaction_id", "conversation_id", "customer_message", "brand_response", "timestamp",
    "customer_author_id", "customer_tweet_id", "brand_tweet_id",
]

GOLDEN_COLUMNS = [
    "example_id", "conversation_id", "interaction_id", "conversation_context", "customer_message",
    "ground_truth_intent", "historical_reference_reply", "is_multi_turn", "message_position",
    "risk_tier", "requires_human_escalation", "escalation_reason", "annotation_notes",
    "annotation_version",
]
