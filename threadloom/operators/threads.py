"""Reply pairs, thread roots, interactions and thread messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.text import is_blank
from threadloom.operators.ordering import SLICE_ROWS, positions
from threadloom.operators.skew import HOT_ROWS, lookup_join
from threadloom.schemas import INTERACTION_COLUMNS
from threadloom.session import materialize

# Brand default, id prefixes and the rendering of the time stamp.
BRAND = "AmazonHelp"
CONVERSATION_PREFIX = "CONV_AH_"
INTERACTION_PREFIX = "INT_AH_"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def brand_replies(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    return tweets.where((F.col("author_id") == brand) & ~F.col("inbound"))


def iso_timestamp(ts: Column, raw: Column) -> Column:
    return F.coalesce(F.date_format(ts, ISO_FORMAT), raw)


def match_parents(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    """Brand replies with the parent's id and direction; null where the parent is not in the data."""
    replies = brand_replies(tweets, brand).where(F.col("parent_id").isNotNull())
    parents = tweets.select(F.col("tweet_id").alias("parent_id"), F.col("inbound").alias("parent_inbound"))
    return replies.join(parents, "parent_id", "left")


def _replies(tweets: DataFrame, brand: str) -> DataFrame:
    return brand_replies(tweets, brand).where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("author_id").alias("brand_author_id"),
        F.col("text").alias("brand_response"),
        F.col("created_at").alias("brand_created_at"),
        F.col("ts").alias("brand_ts"),
    )


def _customers(tweets: DataFrame) -> DataFrame:
    return tweets.where("inbound").select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_author_id"),
        F.col("text").alias("customer_message"),
        F.col("created_at").alias("customer_created_at"),
        F.col("ts").alias("customer_ts"),
        F.col("parent_id").alias("customer_parent_id"),
    )


def reply_pairs(tweets: DataFrame, brand: str = BRAND, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each brand reply next to the customer message it answers."""
    return lookup_join(_replies(tweets, brand), _customers(tweets), "customer_tweet_id", "brand_tweet_id", hot_rows)


def thread_roots(tweets: DataFrame) -> DataFrame:
    """(tweet_id, root_id) for every inbound tweet: its topmost inbound ancestor, or itself.

    Pointer doubling: each round joins the still open pointers with the state and doubles the
    distance covered, so a thread of depth d takes log2(d) joins. A walk stops at a parent that is
    missing. What is still open once the distance exceeds any acyclic length hangs on a reply
    cycle, which ends before the first tweet that would repeat. A repeated id is an error.
    """
    ids = tweets.select(F.col("tweet_id").alias("jump"), F.lit(True).alias("known"))
    repeated = tweets.groupBy("tweet_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"tweet id {repeated[0]['tweet_id']} occurs twice or more")
    links = tweets.select("tweet_id", "inbound", F.col("parent_id").alias("jump")).join(ids, "jump", "left")
    links = materialize(
        links.select("tweet_id", "inbound", F.when(F.col("known"), F.col("jump")).alias("jump")), "thread-links"
    )
    state = links.select("tweet_id", "jump", F.when(F.col("inbound"), F.col("tweet_id")).alias("top"))
    is_open = F.col("jump").isNotNull()
    done, moving = state.where(~is_open), state.where(is_open)
    n_open, distance, bound = moving.count(), 1, None
    while n_open:
        # an open row has at least ``distance`` ancestors, and all but the last of them are open
        longest = n_open + distance
        bound = longest if bound is None else min(bound, longest)
        if distance > bound:
            return _close_cycles(links, done, moving)
        ahead = done.unionByName(moving).select(
            F.col("tweet_id").alias("jump"), F.col("jump").alias("next_jump"), F.col("top").alias("next_top"))
        moved = moving.join(ahead, "jump").select(
            "tweet_id", F.col("next_jump").alias("jump"), F.coalesce("next_top", "top").alias("top"))
        # only rows that moved are written again; finished rows stay where they are
        moved = materialize(moved, "thread-roots")
        done, moving = done.unionByName(moved.where(~is_open)), moved.where(is_open)
        n_open, distance = moving.count(), distance * 2
    return _inbound_roots(links, done)


def _inbound_roots(links: DataFrame, state: DataFrame) -> DataFrame:
    # for an inbound tweet ``top`` is never null, and only inbound tweets start a walk
    return links.where("inbound").select("tweet_id").join(
        state.select("tweet_id", F.col("top").alias("root_id")), "tweet_id")


def _leap(rows: DataFrame, ahead: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(resting, moving): every pointer of ``rows`` (at, jump, found) moved on by what lies ahead of it.

    ``ahead``: at, jump, found. A row rests once ``jump`` is null; ``found`` is the latest that is not null.
    """
    step = ahead.select(F.col("at").alias("jump"), F.col("jump").alias("_jump"), F.col("found").alias("_found"))
    moved = rows.join(step, "jump").select("at", F.col("_jump").alias("jump"), F.coalesce("_found", "found").alias("found"))
    moved = materialize(moved, label)
    return moved.where("jump IS NULL"), moved.where("jump IS NOT NULL")


def _close_cycles(links: DataFrame, done: DataFrame, looping: DataFrame) -> DataFrame:
    """Finish rows that lead into a cycle; the walk of a row ends where it would meet a row again.

    ``looping`` points further ahead than any walk without a repeat is long, so its targets are exactly the rows
    on cycles. A walk that enters a cycle at e visits all of it and ends before e: its last inbound row is the
    first one met backwards from e. Both the way back along the cycles and the way to the entry are found by
    pointer doubling: the logarithm of the longest cycle and of the longest way, in rounds.
    """
    cycle = materialize(looping.select(F.col("jump").alias("at")).distinct(), "cycle-rows")
    parents = links.where(F.col("jump").isNotNull()).select(F.col("tweet_id").alias("at"), F.col("jump").alias("next"), "inbound")
    here = materialize(parents.join(cycle, "at", "left_semi"), "cycle-links")
    # backwards: from a row to the one that names it as its parent, resting where that is inbound
    back = here.select(F.col("next").alias("at"), F.when(~F.col("inbound"), F.col("at")).alias("jump"), F.when(F.col("inbound"), F.col("at")).alias("found"))
    rest, moving = back.where("jump IS NULL"), back.where("jump IS NOT NULL")
    distance, rows = 1, here.count()
    while distance <= rows and not moving.isEmpty():
        found, moving = _leap(moving, rest.unionByName(moving), "cycle-back")
        rest, distance = rest.unionByName(found), distance * 2
    # what still moves is on a cycle without any inbound row
    last = materialize(rest.unionByName(moving.withColumn("found", F.lit(None).cast("bigint"))).select(
        F.col("at").alias("entry"), F.col("found").alias("last")), "cycle-last")
    # forwards: from the rows beside the cycles to their entry, with the last inbound row on the way
    beside = parents.join(looping.select(F.col("tweet_id").alias("at")), "at", "left_semi").join(cycle, "at", "left_anti")
    entries = cycle.select(F.col("at").alias("next"), F.lit(True).alias("enters"))
    way = beside.join(entries, "next", "left").select(
        "at", F.when(F.col("enters").isNull(), F.col("next")).alias("jump"),
        F.struct(F.when(F.col("inbound"), F.col("at")).alias("top"), F.when(F.col("enters"), F.col("next")).alias("entry")).alias("found"))
    way = materialize(way, "cycle-way")
    rest, moving = way.where("jump IS NULL"), way.where("jump IS NOT NULL")
    while not moving.isEmpty():
        step = rest.unionByName(moving).select(F.col("at").alias("jump"), F.col("jump").alias("_jump"), F.col("found").alias("_found"))
        moved = moving.join(step, "jump").select("at", F.col("_jump").alias("jump"), F.struct(
            F.coalesce("_found.top", "found.top").alias("top"), F.col("_found.entry").alias("entry")).alias("found"))
        moved = materialize(moved, "cycle-way")
        rest, moving = rest.unionByName(moved.where("jump IS NULL")), moved.where("jump IS NOT NULL")
    way = rest.select("at", "found.top", "found.entry")
    outside = way.join(last, "entry").select(F.col("at").alias("tweet_id"), F.coalesce("last", "top").alias("top"))
    inside = last.select(F.col("entry").alias("tweet_id"), F.col("last").alias("top"))
    closed = outside.unionByName(inside).select("tweet_id", F.lit(None).cast("bigint").alias("jump"), "top")
    return _inbound_roots(links, done.unionByName(closed))


def rooted_pairs(tweets: DataFrame, brand: str = BRAND, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Reply pairs with their ids and conversation.

    Roots meet the customer messages first, one row to one row; the replies, of which one message
    may have very many, come last and are spread where a message is hot.
    """
    roots = thread_roots(tweets).withColumnRenamed("tweet_id", "customer_tweet_id")
    customers = _customers(tweets).join(roots, "customer_tweet_id")
    return lookup_join(_replies(tweets, brand), customers, "customer_tweet_id", "brand_tweet_id", hot_rows).select(
        "*",
        F.concat(F.lit(CONVERSATION_PREFIX), F.col("root_id")).alias("conversation_id"),
        F.concat(F.lit(INTERACTION_PREFIX), F.col("customer_tweet_id")).alias("interaction_id"),
        iso_timestamp(F.col("customer_ts"), F.col("customer_created_at")).alias("timestamp"),
    )


def _deduplicated(pairs: DataFrame) -> DataFrame:
    """One row per exact (message, reply) text pair: the first by brand tweet id, and the copy count.

    Copies collapse in the map-side aggregate, so a text pair that fills a third of the data
    reaches the shuffle once per task.
    """
    first = F.min(F.struct(
        "brand_tweet_id", "interaction_id", "conversation_id", "timestamp", "customer_ts",
        "customer_author_id", "customer_tweet_id"))
    return (
        pairs.groupBy(F.coalesce("customer_message", F.lit("")).alias("customer_message"),
                      F.coalesce("brand_response", F.lit("")).alias("brand_response"))
        .agg(first.alias("first"), F.count("*").alias("copies"))
        .select("customer_message", "brand_response", "first.*", "copies")
        .withColumn("blank", is_blank(F.col("customer_message")) | is_blank(F.col("brand_response")))
        .withColumn("has_time", ~is_blank(F.col("timestamp")))
    )


def interactions(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    """Clean customer-brand interactions: non-blank, first of exact copies, with a time stamp."""
    return _deduplicated(rooted_pairs(tweets, brand)).where("NOT blank AND has_time").select(
        *INTERACTION_COLUMNS, "customer_ts")


def interaction_funnel(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    """Ten counters from raw rows to clean conversations, as one row."""
    is_reply = (F.col("author_id") == brand) & ~F.col("inbound")
    raw = tweets.agg(
        F.count("*").alias("raw_total_tweets"),
        F.count_if(is_reply).alias("brand_outbound_responses"),
        F.count_if(is_reply & F.col("parent_id").isNull()).alias("missing_parent_id_count"),
    )
    # the parent lookup reads ids and flags only, no text
    parents = match_parents(tweets.select("tweet_id", "author_id", "inbound", "parent_id"), brand).agg(
        F.count_if(F.col("parent_inbound").isNull()).alias("orphan_parent_count"),
        F.count_if(~F.col("parent_inbound")).alias("non_inbound_parent_count"),
    )
    kept = ~F.col("blank") & F.col("has_time")
    clean = (
        _deduplicated(rooted_pairs(tweets, brand))
        .groupBy(F.when(kept, F.col("conversation_id")).alias("conversation_id"))
        .agg(
            F.sum("copies").alias("pairs"),
            F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(F.when(~F.col("blank"), F.col("copies") - 1).otherwise(0)).alias("extra"),
            F.count_if(kept).alias("final"),
        )
        .agg(
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("total_reconstructed_pairs_raw"),
            F.coalesce(F.sum("blank"), F.lit(0)).alias("empty_whitespace_filtered_count"),
            F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_interaction_filtered_count"),
            F.coalesce(F.sum("final"), F.lit(0)).alias("final_clean_interactions"),
            F.count("conversation_id").alias("final_unique_conversations"),
        )
    )
    return one_row(raw, parents, clean)


def one_row(*parts: DataFrame) -> DataFrame:
    """Put single-row frames side by side by stacking them and taking the only value per column."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def thread_messages(tweets: DataFrame, brand: str = BRAND, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Both messages of every pair, once per conversation, numbered by time and id."""
    messages = materialize(thread_message_set(tweets, brand), "messages")
    return positions(messages, ["conversation_id"], F.unix_micros("ts"), ["tweet_id"],
                     "message_position", slice_rows)


def thread_message_set(tweets: DataFrame, brand: str = BRAND) -> DataFrame:
    """The distinct messages of each conversation, without a position."""
    both = F.explode(F.array(
        F.struct(F.col("customer_tweet_id").alias("tweet_id"), F.col("customer_author_id").alias("author_id"),
                 F.lit(True).alias("inbound"), F.col("customer_created_at").alias("created_at"),
                 F.col("customer_ts").alias("ts"), F.col("customer_message").alias("text"),
                 F.col("customer_parent_id").alias("parent_id")),
        F.struct(F.col("brand_tweet_id").alias("tweet_id"), F.col("brand_author_id").alias("author_id"),
                 F.lit(False).alias("inbound"), F.col("brand_created_at").alias("created_at"),
                 F.col("brand_ts").alias("ts"), F.col("brand_response").alias("text"),
                 F.col("customer_tweet_id").alias("parent_id")),
    ))
    return (
        rooted_pairs(tweets, brand).select("conversation_id", both.alias("m"))
        .select("conversation_id", "m.*").dropDuplicates(["conversation_id", "tweet_id"])
    )


def pair_preview(pairs: DataFrame, n: int = 25) -> DataFrame:
    """The first n pairs by brand tweet id as two turns each."""
    turns = F.explode(F.array(
        F.struct(F.lit(1).alias("turn"), F.lit("Customer").alias("speaker"),
                 F.col("customer_author_id").alias("author_id"), F.col("customer_tweet_id").alias("tweet_id"),
                 F.col("customer_created_at").alias("created_at"), F.col("customer_message").alias("text")),
        F.struct(F.lit(2).alias("turn"), F.col("brand_author_id").alias("speaker"),
                 F.col("brand_author_id").alias("author_id"), F.col("brand_tweet_id").alias("tweet_id"),
                 F.col("brand_created_at").alias("created_at"), F.col("brand_response").alias("text")),
    ))
    first = pairs.orderBy("brand_tweet_id").limit(n)
    return first.select("conversation_id", turns.alias("t")).select("conversation_id", "t.*")


def thread_sample(messages: DataFrame, n: int = 50) -> DataFrame:
    """The first n messages in (conversation, position) order with the eight export columns."""
    return messages.orderBy("conversation_id", "message_position").limit(n).select(
        "conversation_id", "message_position", "tweet_id", "author_id", "inbound", "created_at", "text",
        F.col("parent_id").alias("in_response_to_tweet_id"))
