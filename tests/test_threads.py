import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from threadloom.operators import profile, threads
from threadloom.schemas import TWEET_SOURCE
from threadloom.sources.tweets import assert_source, demo_tweets, duplicate_ids, normalise, read_tweets

TIME = "Tue Oct 10 18:{:02d}:00 +0000 2017"


def tweet(i, author, inbound, parent=None, text=None, minute=0, created=None, responses=None):
    return (str(i), author, str(inbound), created or TIME.format(minute), f"text {i}" if text is None else text,
            responses, None if parent is None else f"{parent}.0")


def frame(spark, *rows):
    return normalise(spark.createDataFrame(list(rows), TWEET_SOURCE))


def roots(df):
    return dict(tuples(threads.thread_roots(df)))


def test_demo_rows_give_two_interactions(spark):
    found = threads.interactions(normalise(demo_tweets(spark)))
    assert tuples(found, "interaction_id", "conversation_id", "brand_tweet_id", "timestamp") == [
        ("INT_AH_1", "CONV_AH_1", 2, "2017-10-10T18:00:00+00:00"),
        ("INT_AH_3", "CONV_AH_3", 4, "2017-10-10T18:10:00+00:00")]


def test_demo_brand_ranking(spark):
    assert tuples(profile.brand_ranking(normalise(demo_tweets(spark)))) == [
        ("AmazonHelp", 2, 2), ("AppleSupport", 1, 1)]


def test_root_passes_outbound_ancestors_and_stops_at_missing_parent(spark):
    df = frame(spark, tweet(1, "c", True, 999), tweet(2, "AmazonHelp", False, 1), tweet(3, "c", True, 2),
               tweet(4, "AmazonHelp", False, 3), tweet(5, "c", True, 4))
    assert roots(df) == {1: 1, 3: 1, 5: 1}


def test_root_is_topmost_inbound_not_the_outbound_top(spark):
    df = frame(spark, tweet(1, "AmazonHelp", False), tweet(2, "c", True, 1), tweet(3, "c", True, 2))
    assert roots(df) == {2: 2, 3: 2}


def test_deep_chain(spark):
    df = frame(spark, *[tweet(i, "c", i % 2 == 1, i - 1 if i > 1 else None) for i in range(1, 101)])
    assert set(roots(df).values()) == {1}
    assert len(roots(df)) == 50


def test_cycle_ends_before_a_repeat(spark):
    # 1 <-> 2 both inbound, 3 leads into the cycle; the walk keeps the last inbound tweet it reached
    df = frame(spark, tweet(1, "c", True, 2), tweet(2, "c", True, 1), tweet(3, "c", True, 1), tweet(4, "c", True))
    assert roots(df) == {1: 2, 2: 1, 3: 2, 4: 4}


def root_by_hand(i, parent, inbound):
    seen, top = [], None
    while i is not None and i not in seen:
        seen.append(i)
        top = i if inbound[i] else top
        i = parent.get(i)
    return top


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_with_cycles(spark, seed):
    rng = random.Random(seed)
    n = 150
    parent = {i: rng.choice([None, rng.randrange(n), rng.randrange(n), 999]) for i in range(n)}
    # a long cycle with few inbound rows, one without any, and a long way into a cycle
    parent |= {200 + i: 200 + (i + 1) % 37 for i in range(37)} | {300 + i: 300 + (i + 1) % 5 for i in range(5)}
    parent |= {400 + i: 401 + i for i in range(40)} | {440: 203, 450: 300}
    inbound = {i: rng.random() < 0.4 for i in parent} | {i: False for i in range(300, 305)}
    inbound |= {i: i in (210, 225) for i in range(200, 237)} | {450: True}
    df = frame(spark, *[tweet(i, "c", inbound[i], p) for i, p in parent.items()])
    known = {i: p if p in parent else None for i, p in parent.items()}
    assert roots(df) == {i: root_by_hand(i, known, inbound) for i in parent if inbound[i]}


def test_self_reply_is_its_own_root(spark):
    assert roots(frame(spark, tweet(1, "c", True, 1))) == {1: 1}


def test_two_replies_to_one_parent_stay_two_pairs(spark):
    df = frame(spark, tweet(1, "c", True), tweet(2, "AmazonHelp", False, 1), tweet(3, "AmazonHelp", False, 1))
    pairs = threads.rooted_pairs(df)
    assert tuples(pairs, "interaction_id", "brand_tweet_id") == [("INT_AH_1", 2), ("INT_AH_1", 3)]
    messages = threads.thread_messages(df)
    assert tuples(messages, "message_position", "tweet_id") == [(1, 1), (2, 2), (3, 3)]


def test_funnel_counts_every_reason_to_drop(spark):
    df = frame(
        spark,
        tweet(1, "c", True, text="same"), tweet(2, "AmazonHelp", False, 1, "reply"),
        tweet(3, "c", True, text="same"), tweet(4, "AmazonHelp", False, 3, "reply"),  # exact copy
        tweet(5, "c", True, text=" 　 "), tweet(6, "AmazonHelp", False, 5),  # blank, wide space
        tweet(7, "AmazonHelp", False),  # no parent
        tweet(8, "AmazonHelp", False, 777),  # orphan
        tweet(9, "AmazonHelp", False, 2),  # parent not inbound
        tweet(10, "c", True, created="no date"), tweet(11, "AmazonHelp", False, 10))
    row = threads.interaction_funnel(df).first().asDict()
    assert row == {
        "raw_total_tweets": 11, "brand_outbound_responses": 7, "missing_parent_id_count": 1,
        "orphan_parent_count": 1, "non_inbound_parent_count": 1, "total_reconstructed_pairs_raw": 4,
        "empty_whitespace_filtered_count": 1, "duplicate_interaction_filtered_count": 1,
        "final_clean_interactions": 2, "final_unique_conversations": 2}
    kept = threads.interactions(df)
    # the first copy survives, and an unreadable date keeps its raw text
    assert tuples(kept, "brand_tweet_id", "timestamp") == [(11, "no date"), (2, "2017-10-10T18:00:00+00:00")]


def test_no_pairs_gives_zeros_and_an_empty_frame(spark):
    df = frame(spark, tweet(1, "c", True))
    assert threads.interactions(df).count() == 0
    row = threads.interaction_funnel(df).first()
    assert (row.raw_total_tweets, row.final_clean_interactions, row.final_unique_conversations) == (1, 0, 0)
    assert profile.turn_distribution(threads.interactions(df)).first().total_convs == 0
    assert profile.conversation_lengths(threads.thread_message_set(df)).first().conversations == 0


def test_quality_profile(spark):
    df = frame(spark, tweet(1, "a", True, text="  "), tweet(1, "b", True, text="x", responses="2,3"),
               ("3", "c", "True", "bad", None, None, None))
    got = dict(tuples(profile.quality_profile(df)))
    assert got["rows"] == 3 and got["duplicate_tweet_ids"] == 1 and got["blank_text"] == 2
    assert got["invalid_timestamp"] == 1 and got["multiple_responses"] == 1
    assert got["missing_text"] == 1 and got["missing_pct_parent_id"] == 100
    assert tuples(duplicate_ids(df)) == [(1, 2)]


def test_conversation_lengths_and_turns(spark):
    rows = []
    for conv, pairs in ((100, 1), (200, 2), (300, 3), (400, 4)):
        for p in range(pairs):
            rows.append(tweet(conv + 2 * p, "c", True, conv + 2 * p - 1 if p else None, minute=2 * p))
            rows.append(tweet(conv + 2 * p + 1, "AmazonHelp", False, conv + 2 * p, minute=2 * p + 1))
    df = frame(spark, *rows)
    row = profile.conversation_lengths(threads.thread_message_set(df)).first()
    assert (row.min_length, row.max_length, row.mean_length, row.median_length) == (2, 8, 5.0, 5.0)
    assert (row.two_turn, row.four_plus_turn, row.conversations) == (1, 3, 4)
    turns = profile.turn_distribution(threads.interactions(df)).first()
    # one and two pairs share a bucket
    assert (turns.two_turn_cnt, turns.three_turn_cnt, turns.four_plus_turn_cnt) == (2, 1, 1)
    assert turns.two_turn_pct == 50.0
    assert [r.turn for r in threads.pair_preview(threads.rooted_pairs(df), 1).collect()] == [1, 2]
    assert len(threads.thread_sample(threads.thread_messages(df), 5).columns) == 8


def test_hot_message_is_spread_without_losing_replies(spark):
    rows = [tweet(1, "c", True), tweet(2, "c", True), tweet(3, "c", True, 1)]
    rows += [tweet(100 + i, "AmazonHelp", False, 1 if i % 3 else 2 + i % 2) for i in range(60)]
    df = frame(spark, *rows)
    plain, spread = threads.rooted_pairs(df), threads.rooted_pairs(df, hot_rows=5)
    assert plain.count() == 60
    assert tuples(plain) == tuples(spread.select(*plain.columns))


def test_sliced_positions_equal_plain_positions(spark):
    df = spark.range(200).select(F.lit("one").alias("conversation_id"), (F.col("id") * 7 % 31).alias("at"), "id") \
        .unionByName(spark.range(3).select(F.lit("small").alias("conversation_id"), F.lit(None).cast("long").alias("at"), "id"))
    from threadloom.operators.ordering import positions

    # equal and missing times are cut into slices too
    for n, at in ((300, F.lit(5).cast("long")), (500, F.lit(None).cast("long"))):
        df = df.unionByName(spark.range(80).select(F.lit(f"g{n}").alias("conversation_id"), at.alias("at"), "id"))
    plain = positions(df, ["conversation_id"], F.col("at"), ["id"], "p")
    sliced = positions(df, ["conversation_id"], F.col("at"), ["id"], "p", slice_rows=10)
    assert tuples(plain, "conversation_id", "id", "p") == tuples(sliced, "conversation_id", "id", "p")


def test_tasks_of_a_sliced_table_follow_its_rows_not_its_slices(spark, monkeypatch):
    from threadloom.operators import ordering

    tasks, store = {}, ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df, label: (tasks.update({label: df.rdd.getNumPartitions()}), store(df, label))[1])
    df = spark.range(300).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 31).alias("at"), "id")
    plain = ordering.positions(df, ["g"], F.col("at"), ["id"], "p")
    sliced = ordering.positions(df, ["g"], F.col("at"), ["id"], "p", slice_rows=2)
    assert tasks["slices"] <= 4  # 150 slices
    assert tuples(plain, "g", "id", "p") == tuples(sliced, "g", "id", "p")


def test_csv_scan_keeps_line_breaks_and_quotes(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n')
        f.write(f'1,c,True,{TIME.format(1)},"two\nlines, ""quoted""",2,\n2,AmazonHelp,False,{TIME.format(2)},ok,,1.0\n')
    df = normalise(read_tweets(spark, path))
    assert tuples(df, "tweet_id", "inbound", "text", "parent_id") == [
        (1, True, 'two\nlines, "quoted"', None), (2, False, "ok", 1)]


def test_source_contract_fails_loudly(spark):
    with pytest.raises(ValueError, match="rows"):
        assert_source(demo_tweets(spark), min_rows=7)
    with pytest.raises(ValueError, match="lacks"):
        assert_source(demo_tweets(spark).drop("author_id"), min_rows=1)
    assert assert_source(demo_tweets(spark), min_rows=6).count() == 6


def test_repeated_ids_are_refused(spark):
    df = frame(spark, tweet(1, "c", True), tweet(1, "c", True), tweet(2, "AmazonHelp", False, 1))
    with pytest.raises(ValueError, match="twice"):
        threads.rooted_pairs(df)
