"""Audit of how five text filters interact, over all 120 orders in which they can be applied.

A document is described by a mask: the filters it fails and whether it is labelled good or toxic. Every
mask is mapped to one big integer whose fields hold what the mask adds to each of the 600 steps of all
orders: kept, removed, redundant, failing only here, good lost, toxic lost. The audit of a part is the sum
of its documents' integers, unpacked once.

Fields are 64 bits wide and a field never exceeds the number of documents of its part, which is a long, so
no field carries into the next one. Documents of equal mask are counted before they are summed: a part
sends at most 128 rows to the task that adds its integers, however many documents it has.

Filter E needs the whole table: a text fails if the same text stands under a smaller doc_id. Texts are
compared by SHA-256; copies collapse to one row per (text, part, labels) in map-side aggregates before they
meet, so a text with a third of all rows is a handful of rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.scratch import Scratch

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of one counter; counts of documents are longs.
FIELD_BITS = 64
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
MASKS = 4 << len(FILTERS)

# Limits of the filters.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
SEPARATORS, SYMBOLS, NOT_UPPER = r"[\x20\x09-\x0D]+", r"[#$%&*|]", "[^A-Z]+"

SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in OUTCOMES) + ", shapley long"


def own_failures(text: Column) -> Column:
    """The bits of the filters A to D that a text (not null) fails."""
    words = F.array_remove(F.split(text, SEPARATORS), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(F.regexp_replace(text, NOT_UPPER, ""))
    fails = [
        count < MIN_WORDS,
        100 * distinct.cast("long") < MIN_DISTINCT_PERCENT * count.cast("long"),
        100 * upper.cast("long") > MAX_UPPER_PERCENT * F.length(text).cast("long"),
        text.rlike(SYMBOLS)]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def document_masks(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, n): how many documents of a part have a mask.

    ``docs``: doc_id, text, ``part``; ``labels``: doc_id, quality, toxic. Rows of ``docs`` are counted one by
    one, repeated rows too. Null texts are empty and equal to each other, null parts are the empty string. A
    null doc_id is neither smaller nor larger than another, and has no label; of several label rows of a
    document one that says 1 counts. Rows of equal doc_id and text are not copies of each other.
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"))
    known = known.where("doc_id is not null").groupBy("doc_id").agg((F.max("good") * GOOD + F.max("toxic") * TOXIC).alias("marks"))
    # the text ends here: what goes on is a digest and a few numbers
    read = scratch.store(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), own_failures(text).alias("own")), "read")
    marked = read.join(known, "doc_id", "left").select("doc_id", "part", "digest", "own", F.coalesce("marks", F.lit(0)).alias("marks"))
    keys = ["digest", "part", "own", "marks"]
    per_id = marked.groupBy(*keys, "doc_id").agg(F.count("*").alias("n"))
    # of each (text, part, labels) the rows under the smallest id and under none, and all rows
    nameless = F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    copies = scratch.store(per_id.groupBy(*keys).agg(first.alias("first"), F.sum(nameless).alias("nameless"), F.sum("n").alias("n")), "copies")
    several = copies.groupBy("digest").agg(F.min("first.doc_id").alias("original"), F.count("*").alias("places")).where("places > 1").drop("places")
    here = F.coalesce(F.col("first.doc_id") == F.coalesce("original", "first.doc_id"), F.lit(False))
    passing = F.col("nameless") + F.when(here, F.col("first.n")).otherwise(0)
    counted = copies.join(several, "digest", "left").select(
        "part", (F.col("own") + F.col("marks")).alias("mask"), passing.alias("passing"), (F.col("n") - passing).alias("failing"))
    each = F.explode(F.array(
        F.struct("mask", F.col("passing").alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), F.col("failing").alias("n"))))
    rows = counted.groupBy("part", "mask").agg(F.sum("passing").alias("passing"), F.sum("failing").alias("failing")).select("part", each.alias("e"))
    return rows.where("e.n > 0").groupBy("part", F.col("e.mask").cast("int").alias("mask")).agg(F.sum("e.n").alias("n"))


def outcomes(mask: int) -> list[int]:
    """What a document of this mask adds to each field: for every outcome, order and step."""
    fields = {name: [] for name in OUTCOMES}
    fails = [f for i, f in enumerate(FILTERS) if mask >> i & 1]
    for order in ORDERS:
        gone = False
        for letter in order:
            failing = letter in fails
            removed = failing and not gone
            fields["redundant"].append(failing and gone)
            gone = gone or failing
            fields["kept"].append(not gone)
            fields["removed"].append(removed)
            fields["unique_fails"].append(fails == [letter])
            fields["good_lost"].append(removed and bool(mask & GOOD))
            fields["toxic_lost"].append(removed and bool(mask & TOXIC))
    return [int(x) for name in OUTCOMES for x in fields[name]]


def pack(counts: list[int]) -> int:
    """One integer with a field per count, the first one lowest."""
    return int.from_bytes(np.array(counts, "<u8").tobytes(), "little")


def unpack(total: int) -> np.ndarray:
    """The fields of a sum of packed integers: (outcome, order * step)."""
    fields = len(OUTCOMES) * len(ORDERS) * STEPS
    return np.frombuffer(total.to_bytes(fields * FIELD_BITS // 8, "little"), "<i8").reshape(len(OUTCOMES), -1)


_packed: dict[int, int] = {}


def packed(mask: int) -> int:
    """The integer of a mask, made once per worker."""
    if mask not in _packed:
        _packed[mask] = pack(outcomes(mask))
    return _packed[mask]


def step_filters() -> np.ndarray:
    """The index of the filter applied at each of the 600 steps."""
    return np.array([FILTERS.index(letter) for order in ORDERS for letter in order])


def audit_rows(part: str, total: int) -> pa.Table:
    """The 600 rows of a part from the sum of its integers."""
    fields = dict(zip(OUTCOMES, unpack(total)))
    filters = step_filters()
    shares = np.zeros(len(FILTERS), np.int64)
    np.add.at(shares, filters, fields["removed"])
    steps = len(ORDERS) * STEPS
    return pa.table({
        "part": pa.array([part] * steps, pa.string()),
        "filter_order": pa.array([order for order in ORDERS for _ in order], pa.string()),
        "step": pa.array(list(range(1, STEPS + 1)) * len(ORDERS), pa.int32()),
        **{name: pa.array(values, pa.int64()) for name, values in fields.items()},
        "shapley": pa.array(shares[filters], pa.int64())})


def _sum_part(rows: pa.Table) -> pa.Table:
    """Adds the integers of one part: at most one row per mask."""
    total = sum(n * packed(mask) for mask, n in zip(rows["mask"].to_pylist(), rows["n"].to_pylist()))
    return audit_rows(rows["part"][0].as_py(), total)


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step.

    kept: left after the step; removed: removed here; redundant: failing its filter, but removed before;
    unique_fails: failing its filter only; good_lost, toxic_lost: removed here with that label; shapley: what
    the step's filter removes, summed over all orders. An empty table has no part and gives no row. Nulls,
    copies and repeated rows are treated as ``document_masks`` says; other columns are ignored.
    """
    return document_masks(docs, labels, part).groupBy("part").applyInArrow(_sum_part, SCHEMA)
