"""Tweet sources: CSV scan, source contract, demo rows, type normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.schemas import TWEET_SOURCE
from threadloom.sources.csv_ranges import read_csv_ranges

REQUIRED = ["tweet_id", "author_id", "inbound", "created_at", "text", "in_response_to_tweet_id"]

# The six demo rows.
DEMO_ROWS = [
    ("1", "cust1", "True", "Tue Oct 10 18:00:00 +0000 2017", "@AmazonHelp My order hasn't arrived yet. Order #12345", "2", None),
    ("2", "AmazonHelp", "False", "Tue Oct 10 18:05:00 +0000 2017", "@cust1 We'd like to look into this for you. Please send us your order details via DM.", None, "1.0"),
    ("3", "cust2", "True", "Tue Oct 10 18:10:00 +0000 2017", "@AmazonHelp Can I get a refund for item #999?", "4", None),
    ("4", "AmazonHelp", "False", "Tue Oct 10 18:12:00 +0000 2017", "@cust2 Refunds can be requested via Your Orders page or DM us for help!", None, "3.0"),
    ("5", "cust3", "True", "Tue Oct 10 18:15:00 +0000 2017", "@AppleSupport My iPhone screen is black", "6", None),
    ("6", "AppleSupport", "False", "Tue Oct 10 18:16:00 +0000 2017", "@cust3 We can help. Try force restarting your iPhone.", None, "5.0"),
]


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Scan quoted, multi-line CSV as strings; ``normalise`` gives the types."""
    return (
        spark.read.schema(TWEET_SOURCE).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )


def read_tweets_by_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as ``read_tweets`` for well-formed files, with a task for each byte range of a file."""
    return read_csv_ranges(spark, path, TWEET_SOURCE)


def demo_tweets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEMO_ROWS, TWEET_SOURCE)


def assert_source(df: DataFrame, required: list[str] = REQUIRED, min_rows: int = 10_000) -> DataFrame:
    """Fail loudly on a missing column or a short table; reads no more than ``min_rows`` rows."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    found = df.select(required[0]).limit(min_rows).count()
    if found < min_rows:
        raise ValueError(f"source has {found} rows, expected at least {min_rows}")
    return df


def parse_created_at(created_at: Column) -> Column:
    """Weekday-first or ISO text to timestamp; anything else becomes null."""
    return F.coalesce(
        F.try_to_timestamp(F.substring(created_at, 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy")),
        F.try_to_timestamp(created_at),
    )


def normalise(raw: DataFrame) -> DataFrame:
    """Typed tweets: ids as bigint, flag as boolean, time as timestamp, bad values as null."""
    def to_id(name: str) -> Column:
        return F.col(name).try_cast("double").cast("bigint")

    return raw.select(
        F.coalesce(F.col("tweet_id").try_cast("bigint"), to_id("tweet_id")).alias("tweet_id"),
        "author_id",
        F.col("inbound").try_cast("boolean").alias("inbound"),
        "created_at",
        parse_created_at(F.col("created_at")).alias("ts"),
        "text",
        "response_tweet_id",
        F.coalesce(F.col("in_response_to_tweet_id").try_cast("bigint"),
                   to_id("in_response_to_tweet_id")).alias("parent_id"),
    )


def duplicate_ids(tweets: DataFrame) -> DataFrame:
    """Tweet ids that break the unique-key contract, with their counts."""
    return tweets.groupBy("tweet_id").agg(F.count("*").alias("n")).where("n > 1")
