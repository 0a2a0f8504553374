from conftest import tuples
from pyspark.sql import functions as F

from threadloom.operators import context


def turns(spark, *rows):
    return spark.createDataFrame(rows, "conversation_id string, position long, role string, text string")


def test_context_is_bounded_and_sees_no_future(spark):
    df = turns(spark, *[("c", i, "Customer" if i % 2 == 0 else "AmazonHelp", f" t{i} ") for i in range(8)])
    got = dict(tuples(context.memory_context(df), "position", "context"))
    assert got[0] == "t0"
    assert got[2] == "Preceding Context:\nCustomer: t0\nAmazonHelp: t1\n\nCurrent Inquiry:\nt2"
    assert got[6] == ("Preceding Context:\nCustomer: t2\nAmazonHelp: t3\nCustomer: t4\nAmazonHelp: t5"
                      "\n\nCurrent Inquiry:\nt6")
    assert "t7" not in got[6]


def test_long_history_keeps_its_tail(spark):
    df = turns(spark, ("c", 0, "Customer", "a" * 3000), ("c", 1, "Customer", "now"))
    got = dict(tuples(context.memory_context(df), "position", "context"))
    assert got[1] == "Preceding Context:\n" + "a" * 2000 + "\n\nCurrent Inquiry:\nnow"


def test_blank_id_or_text_is_not_remembered(spark):
    df = turns(spark, ("c", 0, "Customer", ""), ("c", 1, "Customer", "x"), ("", 0, "Customer", "y"))
    assert tuples(context.memory_context(df), "position", "context") == [(1, "x")]


def test_conversations_do_not_mix(spark):
    df = turns(spark, ("a", 0, "Customer", "one"), ("b", 1, "Customer", "two"))
    assert tuples(context.memory_context(df), "context") == [("one",), ("two",)]


def test_explicit_history_replaces_memory(spark):
    df = spark.createDataFrame(
        [([("Customer", "h1"), ("AmazonHelp", "h2"), (None, "h3"), ("Customer", "h4"), ("Customer", "h5")], "now"),
         ([], " alone ")], "history array<struct<role:string,text:string>>, message string")
    got = [r[0] for r in df.select(context.explicit_context(F.col("history"), F.col("message"))).collect()]
    assert got[0] == ("Preceding Context:\nAmazonHelp: h2\nCustomer: h3\nCustomer: h4\nCustomer: h5"
                      "\n\nCurrent Inquiry:\nnow")
    assert got[1] == "alone"


def test_blocked_paths_equal_plain_paths(spark):
    rows = [("hot", i * 3 % 50, "Customer" if i % 3 else "AmazonHelp", f"t{i}") for i in range(50)]
    df = turns(spark, *rows, ("cold", 1, "Customer", "x"))
    plain, blocked = context.memory_context(df), context.memory_context(df, block_rows=6)
    assert tuples(plain, "conversation_id", "position", "context") == tuples(
        blocked, "conversation_id", "position", "context")
    inter = df.select(
        "conversation_id", F.col("position").alias("brand_tweet_id"), F.col("text").alias("customer_message"),
        F.concat(F.lit("r"), "text").alias("brand_response"),
        F.timestamp_seconds(F.floor(F.col("position") / 2)).alias("customer_ts"))
    columns = ["conversation_id", "brand_tweet_id", "conversation_context", "message_position", "is_multi_turn"]
    assert tuples(context.preceding_context(inter), *columns) == tuples(
        context.preceding_context(inter, block_rows=7), *columns)
