"""Views of the driver tables in the shapes the operators take. Every row of a table is used."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.operators import retrieval
from threadloom.operators.replies import TEMPLATES, Template
from threadloom.operators.rules import INTENTS, LABEL_RULES, Rule
from threadloom.session import ship_package
from threadloom.sources.tweets import normalise

BRAND = "Brand"
#: Ids of turns: conversation times this, plus the turn.
TURN_STRIDE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as source tweets: reply to the turn before, with some parents unknown
    (ids divisible by 17) and some pointing two turns up (ids divisible by 19)."""
    turns = table(spark, sf_dir, "conversations")
    tweet_id = F.col("conv_id") * TURN_STRIDE + F.col("turn") + 1
    created = F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    parent = (
        F.when(F.col("turn") == 0, None)
        .when(tweet_id % 17 == 0, -(tweet_id - 1))
        .when((tweet_id % 19 == 0) & (F.col("turn") > 1), tweet_id - 2)
        .otherwise(tweet_id - 1)
    )
    author = F.when(F.col("role") == "assistant", F.lit(BRAND)).when(
        F.col("role") == "system", F.lit("system")).otherwise(F.concat(F.lit("cust"), F.col("conv_id")))
    responses = F.concat(tweet_id + 1, F.when(tweet_id % 23 == 0, F.concat(F.lit(","), tweet_id + 2)).otherwise(""))
    return turns.select(
        tweet_id.cast("string").alias("tweet_id"),
        author.alias("author_id"),
        (F.col("role") == "user").cast("string").alias("inbound"),
        F.date_format(created, "EEE MMM dd HH:mm:ss Z yyyy").alias("created_at"),
        "text",
        responses.alias("response_tweet_id"),
        F.concat(parent.cast("string"), F.lit(".0")).alias("in_response_to_tweet_id"),
    )


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(raw_tweets(spark, sf_dir))


def turns(spark: SparkSession, sf_dir: str, agent: str = BRAND) -> DataFrame:
    """Customer and agent turns in the shape the context operators take; system turns say nothing."""
    role = F.when(F.col("role") == "user", "Customer").otherwise(agent)
    return table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("conversation_id"), F.col("turn").alias("position"), role.alias("role"), "text")


# Keywords that do occur in the invented text of the driver tables, one rule per intent.
PROBE_WORDS = {
    "account_security_access": ("whst",),
    "package_missing_damaged": ("heed",),
    "refund_return_processing": ("ción",),
    "cancellation_modification": ("les",),
    "payment_billing_issues": ("und", "ung"),
    "order_tracking_delivery": ("with",),
    "product_inquiry_availability": ("for",),
}


# Stop words of the phrase query: frequent words of the four languages.
STOP_WORDS = ["de", "la", "en", "die", "der", "und", "the", "and", "of", "to", "in", "le", "el"]


def probe_rules() -> list[Rule]:
    by_intent = {rule.intent: rule for rule in LABEL_RULES}
    return [replace(by_intent[i], words=words) for i, words in PROBE_WORDS.items()]


def probe_templates() -> list[Template]:
    words = [("whst", "heed"), ("ción", "les"), ("und", "ung")]
    return [replace(template, words=w) for template, w in zip(TEMPLATES, words)]


def vectors(spark: SparkSession, sf_dir: str, id_name: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(id_name), F.col("embedding").alias("vector"), "label")


def intent_of_label(label: Column) -> Column:
    """The driver's labels 0-9 stand for the first ten intents."""
    return F.element_at(F.array(*[F.lit(i) for i in INTENTS]), label + 1)


def case_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(queries, corpus): every tenth vector is a query, the others are the cases."""
    is_query = F.col("vec_id") % 10 == 0
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")
    return (rows.where(is_query).withColumnRenamed("vec_id", "query_id"),
            rows.where(~is_query).withColumnRenamed("vec_id", "corpus_id"))


def classified_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query vector with its true intent, the intent and similarity of its nearest case, and
    a zero-shot confidence. Scores are stretched so that the threshold grid cuts through them."""
    queries, corpus = case_vectors(spark, sf_dir)
    nearest = retrieval.knn_join(queries, corpus, 1)
    found = nearest.join(corpus.select("corpus_id", F.col("label").alias("found")), "corpus_id")
    scored = retrieval.zero_shot(queries, retrieval.class_means(vectors(spark, sf_dir, "vec_id"), "label"))
    return scored.join(found.select("query_id", "found", "similarity"), "query_id").select(
        "query_id", "label", F.col("found").alias("predicted_label"),
        intent_of_label(F.col("label")).alias("true_intent"),
        intent_of_label(F.col("found")).alias("predicted_intent"),
        F.round(F.least(F.col("confidence") * 1.5, F.lit(1.0)), 6).alias("intent_confidence"),
        F.round(F.col("similarity") * 1.5, 6).alias("retrieval_similarity"))


def telemetry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telemetry(table(spark, sf_dir, "events"))


def as_telemetry(events: DataFrame) -> DataFrame:
    """Events as decision telemetry: errors and purchases escalate."""
    reason = F.when(F.col("event_type") == "error", "high_risk").when(
        F.col("event_type") == "purchase", "sensitive_account_issue").otherwise("none")
    return events.select(
        F.col("event_id").cast("string").alias("interaction_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.when(F.col("event_type").isin("error", "purchase"), "ESCALATE").otherwise("AUTO").alias("decision"),
        reason.alias("escalation_reason"),
        F.col("event_type").alias("predicted_intent"),
        F.least(F.lit(1.0), F.col("value") / 100).alias("intent_confidence"),
        F.least(F.lit(1.0), F.col("value") / 200).alias("retrieval_similarity"),
        (F.col("value") / 1000).alias("elapsed_seconds"),
        (F.col("event_id") % 4).alias("evidence_count"))


def turn_vectors(inter: DataFrame, spark: SparkSession, sf_dir: str, id_name: str) -> DataFrame:
    """Interactions with the vector that stands for their customer message."""
    vecs = vectors(spark, sf_dir, "vec_id")
    size = vecs.select(F.count("*").alias("n")).scalar()
    place = F.col("customer_tweet_id") - 1
    conv, turn = F.floor(place / TURN_STRIDE), place % TURN_STRIDE
    return inter.withColumn("vec_id", (conv * 8 + turn) % size).join(vecs, "vec_id").withColumn(
        id_name, F.col("brand_tweet_id"))
