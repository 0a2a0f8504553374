"""License scans by diagonal voting.

All rolling hashes of two and three words of every text are joined with those of the phrases and
templates. Hits on a template are votes for a diagonal (place in the text less place in the template);
diagonals at most ``NEAR`` apart are merged, so that inserted or missing words do not split a span, and a
span is verified by the share of the template's places that it covers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.llm.words import ALNUM, hash_words, mix, rolling, span_hashes, text_bytes, words_of

# --- fixed values: public license phrases and notices ---------------------------------------
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "gpl": [
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "cc-by": ["licensed under cc by 4 0", "creative commons attribution 4 0 international license"],
    "all-rights-reserved": ["all rights reserved no part of this publication may be reproduced"],
}
# --------------------------------------------------------------------------------------------

#: Words of a template gram.
K = 3
#: Diagonals at most this far apart are one span.
NEAR = 3
#: Share of a template's places that a verified span covers.
COVERAGE = 0.6
#: The gram that every text has once; its place is the number of words.
TEXT = int(mix(np.array([0x7E87], np.uint64)).view(np.int64)[0])

GRAMS = "doc_id long, text_key long, pairs array<long>, triples array<long>, n_words long"


def _grams_of(text: str, k: int) -> list[int]:
    data, offsets = text_bytes(pa.array([text]))
    words = hash_words(data, offsets, ALNUM)
    return rolling(words.hashes, words.bounds, k)[0].view(np.int64).tolist()


def targets(templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> list[tuple]:
    """(gram, kind, label, template, template_place, places) of each phrase and template place, and of TEXT."""
    rows = [(TEXT, "text", "", -1, 0, 1)]
    for i, (phrase, label) in enumerate(phrases.items()):
        rows.append((_grams_of(phrase, len(phrase.split()))[0], "phrase", label, -1 - i, 0, 1))
    number = 0
    for label, texts in templates.items():
        for text in texts:
            grams = _grams_of(text, K)
            rows += [(g, "template", label, number, place, len(grams)) for place, g in enumerate(grams)]
            number += 1
    return rows


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for first, last, words in words_of(batch.column(1), ALNUM):
            arrays = []
            for k in (2, 3):
                value, bounds = rolling(words.hashes, words.bounds, k)
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(value.view(np.int64))))
            cut = offsets[first:last + 1] - offsets[first]
            key = span_hashes(data[offsets[first]:offsets[last]], cut[:-1], cut[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(key.view(np.int64)), *arrays, pa.array(np.diff(words.bounds))],
                names=["doc_id", "text_key", "pairs", "triples", "n_words"])


def license_hits(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """doc_id, text_key, place and target of each gram of each text that is a target."""
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    grams = named.mapInArrow(_grams, GRAMS)
    each = F.explode(F.array(F.col("pairs"), F.col("triples"), F.array(F.lit(TEXT)))).alias("grams")
    placed = grams.select("doc_id", "text_key", "n_words", each).select(
        "doc_id", "text_key", "n_words", F.posexplode("grams").alias("place", "gram"))
    wanted = spark.createDataFrame(
        targets(templates, phrases), "gram long, kind string, label string, template int, template_place int, places int")
    hits = placed.join(F.broadcast(wanted), "gram")  # as many rows as the given templates have words
    place = F.when(F.col("kind") == "text", F.col("n_words")).otherwise(F.col("place").cast("long"))
    return hits.select("doc_id", "text_key", "kind", "label", "template", "template_place", "places", place.alias("place"))


def spans(hits: DataFrame) -> DataFrame:
    """Verified spans: doc_id, text_key, label, template, first_word, last_word, coverage."""
    votes = hits.where("kind = 'template'").distinct().withColumn("diagonal", F.col("place") - F.col("template_place"))
    of_template = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal", "place")
    step = F.col("diagonal") - F.lag("diagonal").over(of_template)
    merged = votes.withColumn("fresh", F.when(step <= NEAR, 0).otherwise(1)).withColumn(
        "span", F.sum("fresh").over(of_template.rowsBetween(Window.unboundedPreceding, 0)))
    found = merged.groupBy("doc_id", "text_key", "label", "template", "places", "span").agg(
        F.size(F.collect_set("template_place")).alias("covered"), F.min("place").alias("first_word"),
        (F.max("place") + K - 1).alias("last_word"))
    share = F.col("covered") / F.col("places")
    return found.where(share >= COVERAGE).select("doc_id", "text_key", "label", "template", "first_word", "last_word", share.alias("coverage"))


def license_report(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per text of ``docs`` (doc_id, text; more columns are ignored): doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels. ``score`` is the largest coverage of a verified
    span, and 1 where a phrase occurs. Rows that repeat doc_id and text get the same result each.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    hits = scratch.store(license_hits(docs, templates, phrases), "hits")
    key = ["doc_id", "text_key"]
    base = hits.where("kind = 'phrase'").distinct().groupBy(*key).agg(
        F.count("*").alias("n_base"), F.min("place").alias("first_word"), F.max("place").alias("last_word"),
        F.collect_set("label").alias("base_set"), F.lit(1.0).alias("base_score"))
    own = spans(hits).groupBy(*key).agg(F.collect_set("label").alias("own_set"), F.max("coverage").alias("own_score"))
    texts = hits.where("kind = 'text'").select(*key, F.col("place").alias("n_words"))
    found = base.select(F.col("doc_id").alias("bd"), F.col("text_key").alias("bk"), "n_base", "first_word", "last_word", "base_set", "base_score")
    other = own.select(F.col("doc_id").alias("od"), F.col("text_key").alias("ok"), "own_set", "own_score")
    joined = texts.join(found, texts.doc_id.eqNullSafe(F.col("bd")) & (texts.text_key == F.col("bk")), "left").join(
        other, texts.doc_id.eqNullSafe(F.col("od")) & (texts.text_key == F.col("ok")), "left")
    none = F.array().cast("array<string>")
    labels = lambda x: F.array_join(F.sort_array(x), ",")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        labels(F.coalesce("base_set", none)).alias("base_labels"),
        labels(F.array_union(F.coalesce("base_set", none), F.coalesce("own_set", none))).alias("labels"),
        F.greatest(F.coalesce("base_score", F.lit(0.0)), F.coalesce("own_score", F.lit(0.0))).alias("score"))
