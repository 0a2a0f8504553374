import hashlib

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from threadloom.operators import context, splits
from threadloom.operators.ordering import exact_median


@pytest.fixture(scope="module")
def inter(spark):
    # conversation c has c % 4 + 1 pairs
    return spark.range(200).select(F.explode(F.sequence(F.lit(0), F.col("id") % 4)).alias("p"), "id").select(
        F.concat(F.lit("CONV_AH_"), "id").alias("conversation_id"),
        (F.col("id") * 10 + F.col("p")).alias("brand_tweet_id"),
        F.concat(F.lit("INT_AH_"), F.col("id") * 10 + F.col("p")).alias("interaction_id"),
        F.concat(F.lit("m"), "p").alias("customer_message"), F.concat(F.lit("r"), "p").alias("brand_response"),
        F.timestamp_seconds(F.col("p") * 60).alias("customer_ts")).cache()


def expected_split(n):
    order = sorted(range(n), key=lambda i: hashlib.md5(f"42|CONV_AH_{i}".encode()).hexdigest())
    cut1, cut2 = int(n * 0.70), int(n * 0.70) + int(n * 0.15)
    return {f"CONV_AH_{c}": "train" if k < cut1 else "validation" if k < cut2 else "test"
            for k, c in enumerate(order)}


def test_split_is_exact_whole_and_repeatable(inter):
    got = splits.split_conversations(inter).select("conversation_id", "split").distinct()
    assert dict(tuples(got)) == expected_split(200)
    again = splits.split_conversations(inter.repartition(7)).select("conversation_id", "split").distinct()
    assert tuples(got) == tuples(again)


@pytest.mark.parametrize("n", [1, 3, 6])
def test_split_of_few_conversations_uses_floors(inter, n):
    few = inter.where(F.substring("conversation_id", 9, 9).cast("int") < n)
    got = splits.split_conversations(few).select("conversation_id", "split").distinct()
    assert dict(tuples(got)) == expected_split(n)


def test_subset_takes_whole_conversations_until_the_target(inter):
    full = splits.split_conversations(inter).cache()
    sub = splits.sample_subsets(full, {"train": 50, "validation": 0, "test": 10**6})
    rows = {s: full.where(F.col("split") == s).collect() for s in splits.SPLITS}
    sizes = {}
    for r in rows["train"]:
        sizes[r.conversation_id] = sizes.get(r.conversation_id, 0) + 1
    total, chosen = 0, set()
    for c in sorted(sizes, key=lambda c: hashlib.md5(f"43|{c}".encode()).hexdigest()):
        if total >= 50:
            break
        chosen.add(c)
        total += sizes[c]
    got = sub.where("split = 'train'").collect()
    assert {r.conversation_id for r in got} == chosen and len(got) == total
    # a target of zero, or beyond the size, keeps everything
    assert sub.where("split = 'validation'").count() == len(rows["validation"])
    assert sub.where("split = 'test'").count() == len(rows["test"])


def test_no_overlap_and_exact_reconstruction(inter):
    full = splits.split_conversations(inter).cache()
    assert {r.n for r in splits.overlaps(full, "conversation_id", "split", splits.SPLITS).collect()} == {0}
    test = full.where("split = 'test'")
    marked = splits.carve_out(test, 5).cache()
    golden, pool = marked.where("part = 'golden'"), marked.where("part = 'pool'")
    assert golden.count() == 5 and golden.select("conversation_id").distinct().count() == 5
    keys = ["interaction_id", "conversation_id"]
    assert tuple(splits.reconstruction_violations([golden, pool], test, keys).first()) == (0, 0)
    assert tuple(splits.reconstruction_violations([golden], test, keys).first()) == (pool.count(), 0)
    assert tuple(splits.reconstruction_violations([golden, pool, golden], test, keys).first()) == (0, 5)
    shared = full.select("conversation_id", F.lit("train").alias("split")).unionByName(
        full.select("conversation_id", F.lit("test").alias("split")))
    counts = {(r.left_part, r.right_part): r.n
              for r in splits.overlaps(shared, "conversation_id", "split", splits.SPLITS).collect()}
    assert counts == {("train", "validation"): 0, ("train", "test"): 200, ("validation", "test"): 0}


def test_annotation_template_and_reply_integrity(inter):
    with_context = context.preceding_context(inter.where("conversation_id = 'CONV_AH_3'"))
    rows = sorted(splits.annotation_template(with_context).collect(), key=lambda r: r.message_position)
    order = sorted(range(30, 34), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    assert [r.example_id for r in rows] == [f"GOLD_{order.index(i) + 1:03d}" for i in range(30, 34)]
    assert [r.message_position for r in rows] == [1, 3, 5, 7]
    assert rows[2].conversation_context == "Customer: m0\nAmazonHelp: r0\nCustomer: m1\nAmazonHelp: r1"
    assert rows[0].annotation_version == "phase4_v1" and rows[0].risk_tier == ""
    template = splits.annotation_template(with_context)
    assert splits.reply_violations(template, inter).count() == 0
    assert splits.reply_violations(template.withColumn("historical_reference_reply", F.lit("made up")), inter).count() == 4


def test_calibration_excludes_and_raises(inter):
    golden = inter.where("conversation_id IN ('CONV_AH_1', 'CONV_AH_2')")
    sample = splits.calibration_sample(inter, [golden], 30)
    assert sample.count() == 30
    assert sample.join(golden, "conversation_id", "left_semi").count() == 0
    assert tuples(sample, "calib_id")[0] == ("CALIB_001",)
    with pytest.raises(ValueError, match="calibration"):
        splits.calibration_sample(golden, [golden], 1)


def test_median_is_exact(spark):
    for values in ([3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [float(i * i % 997) for i in range(5000)], [2.0 ** i for i in range(60)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        ordered = sorted(values)
        middle = (ordered[(len(values) - 1) // 2] + ordered[len(values) // 2]) / 2
        assert exact_median(df, "v").first()["median"] == middle
        assert exact_median(df, "v", most=3).first()["median"] == middle
    assert exact_median(spark.createDataFrame([], "v double"), "v").first()["median"] is None
