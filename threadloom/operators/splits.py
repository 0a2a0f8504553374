"""Leak-free splits by conversation, working subsets, golden carve-out and their checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.ordering import cut_keys, global_rank, order_key
from threadloom.operators.profile import turn_distribution
from threadloom.schemas import GOLDEN_COLUMNS

# Split shares, subset targets, seeds and label formats.
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.15
SUBSET_TARGETS = {"train": 35_000, "validation": 7_500, "test": 7_500}
SPLIT_SEED, CALIBRATION_SEED = 42, 100
GOLDEN_SIZE, CALIBRATION_SIZE = 200, 300
ANNOTATION_VERSION = "phase4_v1"
SPLITS = ["train", "validation", "test"]


def split_column(ids: DataFrame, id_column: str, seed: int = SPLIT_SEED,
                 train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE) -> Column:
    """The split of an id: floor(train N) first ids of the seeded order, then floor(validation N).

    Only two cut keys are looked up, as one row, so assigning a split to any table is a comparison
    with two literals: no join, no shuffle.
    """
    keyed = ids.select(id_column).distinct().select(order_key(seed, id_column).alias("key"))
    n_train, n_validation = F.floor(F.col("total") * train), F.floor(F.col("total") * validation)
    cuts = cut_keys(keyed, {"train": n_train, "validation": n_train + n_validation}).first()
    key = order_key(seed, id_column)
    return F.when(key <= F.lit(cuts["train"]), "train").when(key <= F.lit(cuts["validation"]), "validation") \
        .otherwise("test")


def split_conversations(inter: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Interactions with their ``split``; all rows of a conversation share one."""
    return inter.withColumn("split", split_column(inter, "conversation_id", seed))


def sample_subsets(split: DataFrame, targets: dict[str, int] = SUBSET_TARGETS,
                   seed: int = SPLIT_SEED) -> DataFrame:
    """Whole conversations of each split, in seeded order, until the target row count is reached.

    A target below one, or not below the split's size, keeps the split whole.
    """
    offsets = {name: seed + 1 + i for i, name in enumerate(SPLITS)}
    split_seed, target = F.lit(None), F.lit(0)
    for name in SPLITS:
        split_seed = F.when(F.col("split") == name, offsets[name]).otherwise(split_seed)
        target = F.when(F.col("split") == name, targets.get(name, 0)).otherwise(target)
    key = order_key(split_seed, "conversation_id")
    sizes = split.groupBy("split", "conversation_id").agg(F.count("*").alias("n")).withColumn("key", key)
    cuts = cut_keys(sizes, {"cut": target}, F.col("n"), ["split"]).collect()  # at most one row per split
    keep = F.lit(True)
    for row in cuts:
        keep = F.when(F.col("split") == row["split"], key <= row["cut"]).otherwise(keep)
    return split.where(keep)


def overlaps(df: DataFrame, id_column: str, part: str, parts: list[str]) -> DataFrame:
    """Ids present in both parts, for each pair of parts: one aggregate instead of joins."""
    flags = df.groupBy(id_column).agg(*[F.max((F.col(part) == p).cast("int")).alias(p) for p in parts])
    pairs = list(combinations(parts, 2))
    counts = flags.agg(*[
        F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(f"{a}|{b}") for a, b in pairs])
    long = counts.unpivot([], counts.columns, "pair", "n")
    return long.select(
        F.lit(id_column).alias("id"), F.split("pair", r"\|")[0].alias("left_part"),
        F.split("pair", r"\|")[1].alias("right_part"), "n")


def split_statistics(split: DataFrame, subset: DataFrame) -> DataFrame:
    """Rows, conversations and turn distribution of each full split and working subset."""
    both = split.select(F.lit("full").alias("scope"), "split", "conversation_id").unionByName(
        subset.select(F.lit("working").alias("scope"), "split", "conversation_id"))
    sizes = both.groupBy("scope", "split", "conversation_id").agg(F.count("*").alias("n")).groupBy(
        "scope", "split").agg(F.sum("n").alias("interactions"))
    return turn_distribution(both, ["scope", "split"]).join(sizes, ["scope", "split"])


def seeded_sample(df: DataFrame, n: int, seed: int, ids: list[str]) -> DataFrame:
    """The first n rows in seeded order."""
    return df.orderBy(order_key(seed, *ids), *ids).limit(n)


def single_pair_conversations(inter: DataFrame) -> DataFrame:
    return inter.groupBy("conversation_id").agg(F.count("*").alias("n")).where("n = 1").select("conversation_id")


def carve_out(test: DataFrame, n: int = GOLDEN_SIZE, seed: int = SPLIT_SEED) -> DataFrame:
    """Mark ``part``: 'golden' for n sampled single-pair conversations, 'pool' for the rest."""
    sampled = seeded_sample(single_pair_conversations(test), n, seed, ["conversation_id"])
    # the sample has at most n rows
    marked = test.join(F.broadcast(sampled.withColumn("golden", F.lit(True))), "conversation_id", "left")
    return marked.withColumn("part", F.when(F.col("golden"), "golden").otherwise("pool")).drop("golden")


def reconstruction_violations(parts: list[DataFrame], whole: DataFrame, keys: list[str]) -> DataFrame:
    """Rows missing from, or extra in, the union of the parts compared with the whole, with counts."""
    signed = whole.select(*keys, F.lit(1).alias("sign"))
    for part in parts:
        signed = signed.unionByName(part.select(*keys, F.lit(-1).alias("sign")))
    return (
        signed.groupBy(*keys).agg(F.sum("sign").alias("excess"))
        .agg(F.coalesce(F.sum(F.greatest("excess", F.lit(0))), F.lit(0)).alias("missing"),
             F.coalesce(F.sum(F.greatest(-F.col("excess"), F.lit(0))), F.lit(0)).alias("extra"))
    )


def numbered(df: DataFrame, prefix: str, name: str, seed: int, ids: list[str]) -> DataFrame:
    """Sequential labels ``PREFIX_001`` in seeded order."""
    ranked = global_rank(df, order_key(seed, *ids), "number")
    return ranked.withColumn(name, F.format_string(f"{prefix}_%03d", F.col("number"))).drop("number")


def annotation_template(golden_with_context: DataFrame) -> DataFrame:
    """The 14-column annotation table with blank label columns."""
    rows = numbered(golden_with_context, "GOLD", "example_id", SPLIT_SEED, ["brand_tweet_id"])
    blank = F.lit("")
    return rows.select(
        "*", F.col("brand_response").alias("historical_reference_reply"),
        *[blank.alias(c) for c in ("ground_truth_intent", "risk_tier", "requires_human_escalation",
                                   "escalation_reason", "annotation_notes")],
        F.lit(ANNOTATION_VERSION).alias("annotation_version"),
    ).select(*GOLDEN_COLUMNS)


def calibration_sample(validation: DataFrame, excluded: list[DataFrame], n: int = CALIBRATION_SIZE,
                       seed: int = CALIBRATION_SEED) -> DataFrame:
    """n validation rows outside every excluded conversation, labelled ``CALIB_001``…; too few are an error."""
    candidates = validation
    if excluded:
        taken = excluded[0].select("conversation_id")
        for other in excluded[1:]:
            taken = taken.unionByName(other.select("conversation_id"))
        candidates = validation.join(taken.distinct(), "conversation_id", "left_anti")
    found = candidates.select("conversation_id").limit(n).count()
    if found < n:
        raise ValueError(f"{found} calibration candidates, {n} needed")
    ids = ["brand_tweet_id"]
    sample = seeded_sample(candidates, n, seed, ids)
    return numbered(sample, "CALIB", "calib_id", seed, ids)


def reply_violations(labelled: DataFrame, source: DataFrame) -> DataFrame:
    """Labelled rows whose (interaction, reply) pair does not exist in the source."""
    known = source.select("interaction_id", F.col("brand_response").alias("historical_reference_reply"))
    return labelled.join(known, ["interaction_id", "historical_reference_reply"], "left_anti")
