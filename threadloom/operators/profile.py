"""Profiles of the tweet table, brands, threads and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.functions.numbers import round_even
from threadloom.functions.text import is_blank
from threadloom.operators.threads import BRAND, brand_replies, match_parents, one_row, rooted_pairs

COLUMNS = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "parent_id"]


def quality_profile(tweets: DataFrame) -> DataFrame:
    """(metric, value): row count, nulls and null share per column, duplicate ids, blank text,
    unreadable times and reply lists. One scan, plus one aggregate over the ids."""
    def share(name: str):
        return F.round(F.count_if(F.col(name).isNull()) * 100.0 / F.count("*"), 6)

    scan = tweets.agg(
        F.count("*").cast("double").alias("rows"),
        *[F.count_if(F.col(c).isNull()).cast("double").alias(f"missing_{c}") for c in COLUMNS],
        *[share(c).alias(f"missing_pct_{c}") for c in COLUMNS],
        F.count_if(is_blank(F.col("text"))).cast("double").alias("blank_text"),
        F.count_if(F.col("ts").isNull()).cast("double").alias("invalid_timestamp"),
        F.count_if(F.col("response_tweet_id").contains(",")).cast("double").alias("multiple_responses"),
    )
    ids = tweets.groupBy("tweet_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("duplicate_tweet_ids"))
    row = one_row(scan, ids)
    return row.unpivot([], row.columns, "metric", "value")


def brand_ranking(tweets: DataFrame, n: int = 20) -> DataFrame:
    """Support accounts by number of replies, with the distinct messages they answered."""
    # two-level count: a brand with a third of the rows is spread over its parents first
    per_parent = tweets.where(~F.col("inbound")).groupBy("author_id", "parent_id").agg(F.count("*").alias("n"))
    return (
        per_parent.groupBy(F.col("author_id").alias("brand"))
        .agg(F.sum("n").alias("brand_responses"), F.count("parent_id").alias("direct_queries"))
        .orderBy(F.desc("brand_responses"), "brand").limit(n)
    )


def thread_metrics(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    """One row: usable pairs, orphan share, repeated customer texts, mean text lengths."""
    replies = brand_replies(tweets, brand).agg(
        F.count("*").alias("brand_responses"),
        F.count("parent_id").alias("responses_with_parent"),
    )
    parents = match_parents(tweets.select("tweet_id", "author_id", "inbound", "parent_id"), brand).agg(
        F.count_if(F.col("parent_inbound").isNull()).alias("missing_parent_count"),
        F.count_if(~F.col("parent_inbound")).alias("non_inbound_parent_count"),
    )
    # texts are counted per distinct text first, so copies shrink before the shuffle
    customers = tweets.where("inbound").select(F.col("tweet_id").alias("parent_id"), F.col("text").alias("message"))
    texts = (
        brand_replies(tweets, brand).where(F.col("parent_id").isNotNull())
        .select("parent_id", F.length("text").alias("reply_chars")).join(customers, "parent_id")
        .groupBy("message").agg(F.count("*").alias("n"), F.sum("reply_chars").alias("reply_chars"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("usable_pairs"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_customer_texts"),
            F.sum(F.col("n") * F.length("message")).alias("message_chars"),
            F.sum("reply_chars").alias("reply_chars"),
        )
    )
    row = one_row(replies, parents, texts)

    def ratio(top: str, bottom: str, scale: float):
        return F.coalesce(F.round(F.try_divide(F.col(top) * F.lit(scale), F.col(bottom)), 6), F.lit(0.0))

    return row.select(
        "brand_responses", "responses_with_parent", "usable_pairs", "missing_parent_count",
        "non_inbound_parent_count", "duplicate_customer_texts",
        ratio("missing_parent_count", "responses_with_parent", 100.0).alias("missing_parent_pct"),
        ratio("duplicate_customer_texts", "usable_pairs", 100.0).alias("duplicate_rate_pct"),
        F.coalesce(F.round((F.col("brand_responses") - F.col("responses_with_parent")) * 100.0
                           / F.nullif("brand_responses", F.lit(0)), 6), F.lit(0.0)).alias("missing_in_response_to_pct"),
        ratio("message_chars", "usable_pairs", 1.0).alias("avg_customer_chars"),
        ratio("reply_chars", "usable_pairs", 1.0).alias("avg_brand_chars"),
    )


def conversation_lengths(message_set: DataFrame) -> DataFrame:
    """One row: min, max, mean and median messages per conversation and the 1/2/3/4+ buckets."""
    # conversations of one length count once, so the median reads a short table of lengths
    lengths = message_set.groupBy("conversation_id").agg(F.count("*").alias("n"))
    per_length = lengths.groupBy("n").agg(F.count("*").alias("c"))

    def bucket(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("c"))), F.lit(0))

    zero = F.lit(0)
    return per_length.agg(
        F.coalesce(F.min("n"), zero).alias("min_length"),
        F.coalesce(F.max("n"), zero).alias("max_length"),
        F.coalesce(F.round(F.sum(F.col("n") * F.col("c")) / F.sum("c"), 6), F.lit(0.0)).alias("mean_length"),
        F.coalesce(F.percentile("n", 0.5, F.col("c")), F.lit(0.0)).alias("median_length"),
        bucket(F.col("n") == 1).alias("one_turn"),
        bucket(F.col("n") == 2).alias("two_turn"),
        bucket(F.col("n") == 3).alias("three_turn"),
        bucket(F.col("n") >= 4).alias("four_plus_turn"),
        F.coalesce(F.sum("c"), zero).alias("conversations"),
    )


def turn_distribution(inter: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Conversations with 1-2, 3 and 4+ interactions, with shares; a full row of zeros when empty."""
    by = by or []
    per_length = (
        inter.groupBy(*by, "conversation_id").agg(F.count("*").alias("n"))
        .groupBy(*by, "n").agg(F.count("*").alias("c"))
    )

    def bucket(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("c"))), F.lit(0))

    counts = per_length.groupBy(*by).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_convs"),
        bucket(F.col("n") <= 2).alias("two_turn_cnt"),
        bucket(F.col("n") == 3).alias("three_turn_cnt"),
        bucket(F.col("n") >= 4).alias("four_plus_turn_cnt"),
    )

    def pct(name: str):
        share = round_even(F.try_divide(F.col(name) * 100.0, F.col("total_convs")), 2)
        return F.coalesce(share, F.lit(0.0))

    return counts.select(
        "*", pct("two_turn_cnt").alias("two_turn_pct"), pct("three_turn_cnt").alias("three_turn_pct"),
        pct("four_plus_turn_cnt").alias("four_plus_turn_pct"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) of one column."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    total = df.select(F.count("*").alias("t")).scalar()
    return counts.select("value", "n", F.round(F.col("n") * 100.0 / total, 6).alias("pct"))
