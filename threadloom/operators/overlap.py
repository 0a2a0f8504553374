"""BLEU and ROUGE per pair and as corpus means."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.functions.text import split_words

SCORES = ["bleu_1", "bleu_2", "bleu_4", "rouge_1", "rouge_2", "rouge_l"]


def _share(common: Column, size: Column) -> Column:
    return F.when(size > 0, common / size).otherwise(0.0)


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def overlap_scores(df: DataFrame, hypothesis: str, reference: str) -> DataFrame:
    """Adds BLEU-1/2/4 and ROUGE-1/2/L. Each row is scored on its own: no explode, no shuffle."""
    row = F.struct(*df.columns)
    words = df.select(row.alias("row"), split_words(F.col(hypothesis)).alias("h"), split_words(F.col(reference)).alias("r"))
    counted = words.select(
        "row", shared_grams(F.col("h"), F.col("r")).alias("shared"), F.size("h").alias("nh"), F.size("r").alias("nr")
    ).select("row", "shared.*", "nh", "nr")
    hyp, ref = F.col("nh"), F.col("nr")
    p = {n: _share(F.col(f"grams{n}"), hyp - (n - 1)) for n in (1, 2, 4)}
    r = {n: _share(F.col(f"grams{n}"), ref - (n - 1)) for n in (1, 2)}
    # the brevity penalty is 1 only for a longer hypothesis; BLEU-4 leaves the 3-gram term out
    bp = F.when(hyp > ref, 1.0).when(hyp > 0, F.exp(1 - ref / F.greatest(hyp, F.lit(1)))).otherwise(0.0)
    product = p[1] * p[2] * p[4]
    return counted.select(
        "row.*",
        (bp * p[1]).alias("bleu_1"), (bp * F.sqrt(p[1] * p[2])).alias("bleu_2"),
        F.when(product > 0, bp * F.pow(product, F.lit(0.25))).otherwise(0.0).alias("bleu_4"),
        _f1(p[1], r[1]).alias("rouge_1"), _f1(p[2], r[2]).alias("rouge_2"),
        _f1(_share(F.col("lcs"), hyp), _share(F.col("lcs"), ref)).alias("rouge_l"))


def corpus_means(scored: DataFrame) -> DataFrame:
    """One row: pair count and mean of each score, zero without pairs."""
    return scored.agg(F.count("*").alias("pairs"), *[
        F.coalesce(F.round(F.avg(s), 6), F.lit(0.0)).alias(s) for s in SCORES if s in scored.columns])


def lcs_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel: one big-integer step per left word."""
    places: dict[str, int] = {}
    for i, word in enumerate(right):
        places[word] = places.get(word, 0) | (1 << i)
    full = (1 << len(right)) - 1
    row = full
    for word in left:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(right) - row.bit_count()


def _common(left: list[str], right: list[str], n: int) -> int:
    sides = [Counter(zip(*[words[i:] for i in range(n)])) for words in (left, right)]
    return (sides[0] & sides[1]).total()


_SHARED = T.StructType([T.StructField(name, T.IntegerType()) for name in ("grams1", "grams2", "grams4", "lcs")])


@F.pandas_udf(_SHARED)
def shared_grams(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """Shared 1-, 2- and 4-grams as multisets, and the common subsequence, of two word arrays.

    One Arrow pass: folding the same multisets with higher-order functions took ten times as long.
    """
    rows = []
    for a, b in zip(left, right):
        a, b = list(a), list(b)
        rows.append((*[_common(a, b, n) for n in (1, 2, 4)], lcs_length(a, b)))
    return pd.DataFrame(rows, columns=_SHARED.names, dtype="int32")
