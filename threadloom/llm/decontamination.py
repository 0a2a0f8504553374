"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a fixed mask over consecutive words: only the words at its marked places enter the hash, so a
replaced word at an ignored place does not break a hit. Hashes of the texts are joined with those of
the benchmark items; a hit gives a diagonal (place in the text less place in the item). On each diagonal
that was hit the words are compared one by one: a match counts 1 and a mismatch -2, and the best
scoring stretch must reach a score that follows from the item's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.session import broadcast_if_small

#: Places of the words that count, from 0; fixed values.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 2, 3, 6, 7))
MISMATCH = -2
MIN_SCORE = 12
#: A stretch also counts from this share of the item's words as its score, and a diagonal from this share of the
#: item's words that agree.
ITEM_SCORE, ITEM_AGREE = 0.75, 0.7
#: Items that no mask fits count where they stand word for word; shorter ones only as a whole text.
MIN_RUN = 3
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text: runs of ASCII letters and digits and of all other characters."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _BETWEEN), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(mask_id: int, mask: tuple[int, ...]) -> Column:
    """The hash of each place of ``w`` at which the mask fits; the last ones have none."""
    count = F.size("w") - mask[-1]
    one = lambda i: F.xxhash64(F.lit(mask_id), *[F.get("w", i + j) for j in mask])
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, one)


def seeds(hashed: DataFrame, *keys: str) -> DataFrame:
    """keys, place, seed for every mask and place of the word hashes ``w``."""
    by_mask = F.explode(F.array(*[_seeds(i, m) for i, m in enumerate(MASKS)])).alias("found")
    return hashed.select(*keys, by_mask).select(*keys, F.posexplode("found").alias("place", "seed"))


def stretch_score(pairs: Column) -> Column:
    """The best sum of a run of booleans that count 1 or MISMATCH."""
    start = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"))

    def step(acc, same):
        here = F.greatest(acc["here"], F.lit(0)) + F.when(same, 1).otherwise(MISMATCH)
        return F.struct(here.alias("here"), F.greatest(acc["best"], here).alias("best"))

    return F.aggregate(pairs, start, step, lambda acc: acc["best"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))


def _scored(keyed: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text_key, item_id, words (of the item), line (score, minus_place, matched) of every diagonal hit."""
    asked = scratch.store(seeds(items, "item_id").select("item_id", F.col("place").alias("item_place"), "seed"), "item-seeds")
    found = seeds(keyed.select("doc_id", "text_key", word_hashes(F.col("text")).alias("w")), "doc_id", "text_key")
    hits = found.join(broadcast_if_small(asked), "seed").select(
        "doc_id", "text_key", "item_id", (F.col("place") - F.col("item_place")).alias("diagonal"))
    hits = scratch.store(hits.distinct(), "hits")
    wanted = scratch.store(hits.select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key")).distinct(), "hit-docs")
    same_doc = keyed.doc_id.eqNullSafe(F.col("hit_doc")) & (keyed.text_key == F.col("hit_key"))
    texts = keyed.join(wanted, same_doc, "left_semi").dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("t_doc"), F.col("text_key").alias("t_key"), word_hashes(F.col("text")).alias("w"))
    lines = hits.join(texts, hits.doc_id.eqNullSafe(F.col("t_doc")) & (hits.text_key == F.col("t_key"))).join(
        items.select("item_id", F.col("w").alias("item_w")).withColumn("item_id", F.col("item_id")), "item_id")
    same = F.transform("item_w", lambda word, i: F.coalesce(F.get("w", F.col("diagonal") + i) == word, F.lit(False)))
    return lines.select("doc_id", "text_key", "item_id", "diagonal", F.size("item_w").alias("words"), same.alias("same")).select(
        "doc_id", "text_key", "item_id", "words", F.struct(
            stretch_score(F.col("same")).alias("score"), (-F.col("diagonal")).alias("minus_place"),
            F.size(F.filter("same", lambda x: x)).alias("matched")).alias("line"))


def _word_for_word(keyed: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text_key, item_id, place of the items that stand somewhere word for word; those below MIN_RUN words only as a whole text."""
    asked = scratch.store(items.select("item_id", F.size("w").alias("n"), F.xxhash64("w").alias("seed")), "short-items")
    none = F.array().cast("array<struct<n:int,seed:bigint,place:int>>")

    def runs(n: int) -> Column:
        fits = F.size("w") >= n if n >= MIN_RUN else F.size("w") == n
        each = F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.struct(
            F.lit(n).alias("n"), F.xxhash64(F.slice("w", i + 1, n)).alias("seed"), i.alias("place")))
        return F.when(fits, each).otherwise(none)

    # lengths below the span of a mask: a few numbers
    lengths = sorted(r.n for r in asked.select("n").distinct().collect())
    words = keyed.select("doc_id", "text_key", word_hashes(F.col("text")).alias("w"))
    found = words.select("doc_id", "text_key", F.explode(F.concat(none, *[runs(n) for n in lengths])).alias("run"))
    return found.select("doc_id", "text_key", "run.*").join(broadcast_if_small(asked), ["n", "seed"]).groupBy(
        "doc_id", "text_key", "item_id").agg(F.min("place").alias("place"), F.first("n").alias("n"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: doc_id, text_key, item_id, doc_place, matched, score.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; more columns are ignored. A diagonal counts if its score
    reaches MIN_SCORE or ITEM_SCORE of the item's words, or if ITEM_AGREE of the item's words agree. Items below the
    span of the masks have no seeds and are found word for word, those below MIN_RUN words as a whole text only. One row per
    document and item, for the best diagonal that counts (the first in the text among equals): ``doc_place`` is where
    the item's first word would stand, ``matched`` how many words agree. An item is its id and its words: a null id
    is an id, and two texts of one id are two items. Null and empty texts and items hold nothing. Rows that repeat doc_id and
    text count once; ``text_key`` is a hash of the text.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    named = benchmark.select(F.col("item_id").cast("long").alias("name"), word_hashes(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    key = F.xxhash64(F.col("name").isNull(), "name", "w")
    items = scratch.store(named.select(key.alias("item_id"), "name", "w"), "items")
    span = min(mask[-1] for mask in MASKS) + 1
    keyed = _keyed(docs)
    words, score, matched = F.col("words"), F.col("line.score"), F.col("line.matched")
    enough = (score >= MIN_SCORE) | (score >= F.ceil(ITEM_SCORE * words)) | (matched * 10 >= words * int(ITEM_AGREE * 10))
    best = _scored(keyed, items.where(F.size("w") >= span).select("item_id", "w"), scratch).where(enough).groupBy(
        "doc_id", "text_key", "item_id").agg(F.max("line").alias("line"))
    found = best.select("doc_id", "text_key", "item_id", (-F.col("line.minus_place")).cast("long").alias("doc_place"),
                        F.col("line.matched").cast("long").alias("matched"), F.col("line.score").cast("long").alias("score"))
    short = items.where(F.size("w") < span)
    if not short.isEmpty():
        whole = _word_for_word(keyed, short.select("item_id", "w"), scratch)
        found = found.unionByName(whole.select("doc_id", "text_key", "item_id", F.col("place").cast("long").alias("doc_place"),
                                               F.col("n").cast("long").alias("matched"), F.col("n").cast("long").alias("score")))
    names = scratch.store(items.select(F.col("item_id").alias("key"), "name"), "names")
    return found.join(broadcast_if_small(names), F.col("item_id") == F.col("key")).select(
        "doc_id", "text_key", F.col("name").alias("item_id"), "doc_place", "matched", "score")


def copies_by_item(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key of documents that hold an item, judged by the item's length.

    A diagonal counts from MIN_SCORE or ITEM_SCORE of the item's words, or if ITEM_AGREE of them agree. Items
    below the masks' span are found word for word. Items are told apart by their words; item_id is not read.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    keyed = _keyed(docs)
    items = benchmark.select(word_hashes(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    items = scratch.store(items.select(F.xxhash64("w").alias("item_id"), "w"), "items")
    words = F.col("words")
    enough = (F.col("line.score") >= F.least(F.lit(MIN_SCORE), F.ceil(ITEM_SCORE * words))) | (F.col("line.matched") >= ITEM_AGREE * words)
    found = _scored(keyed, items, scratch).where(enough).select("doc_id", "text_key")
    span = min(mask[-1] for mask in MASKS) + 1
    short = scratch.store(items.where(F.size("w") < span).select(F.size("w").alias("n"), F.xxhash64("w").alias("seed")).distinct(), "short")
    lengths = sorted(r.n for r in short.select("n").distinct().collect())
    if lengths:
        run = lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(F.lit(n).alias("n"), F.xxhash64(F.slice("w", i, n)).alias("seed")))
        none = F.array().cast("array<struct<n:int,seed:bigint>>")
        fits = lambda n: F.size("w") >= n if n >= MIN_RUN else F.size("w") == n
        runs = F.concat(*[F.when(fits(n), run(n)).otherwise(none) for n in lengths])
        whole = keyed.select("doc_id", "text_key", word_hashes(F.col("text")).alias("w")).select("doc_id", "text_key", F.explode(runs).alias("run"))
        whole = whole.select("doc_id", "text_key", "run.*").join(broadcast_if_small(short), ["n", "seed"], "left_semi")
        found = found.unionByName(whole.select("doc_id", "text_key"))
    return found.distinct()


def clean(docs: DataFrame, benchmark: DataFrame, by_item: bool = False) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, with all their columns; ``by_item`` does not read item_id."""
    found = copies_by_item(docs, benchmark) if by_item else overlaps(docs, benchmark)
    found = found.select(F.col("doc_id").alias("_hit_doc"), F.col("text_key").alias("_hit_key")).distinct()
    here = docs.doc_id.cast("long").eqNullSafe(F.col("_hit_doc")) & (F.xxhash64(docs.text.cast("string")) == F.col("_hit_key"))
    return docs.join(found, here, "left_anti")
