"""Seeded order, exact cuts and positions that never need one big partition.

A seeded shuffle is replaced by the order of ``md5(seed|id)``: the same on every run, cluster size
and engine. Cuts in that order are found from bucket totals, so the data itself is never sorted
globally; positions inside a group are found slice by slice where a group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom.session import broadcast_if_small, materialize

#: Groups longer than this are cut into slices before a window or a collect sees them.
SLICE_ROWS = 1_000_000


def order_key(seed: int | Column, *ids: Column | str) -> Column:
    """Position of a row in the seeded order, as a hex string."""
    cols = [F.col(c) if isinstance(c, str) else c for c in ids]
    first = seed if isinstance(seed, Column) else F.lit(seed)
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in [first, *cols]]))


def cut_keys(keyed: DataFrame, targets: dict[str, Column], weight: Column | None = None,
             by: list[str] | None = None) -> DataFrame:
    """For each target, the first key at which the running weight in key order reaches it.

    ``keyed`` has a hex column ``key``. Two passes: totals per 4-digit key prefix (at most 65,536
    rows per group) locate the one prefix that holds the cut, then only that prefix is ordered.
    A target column may use ``total``, the group's whole weight. Output: ``by`` + one column per
    target, null where the target is below one or above the total.
    """
    by = by or []
    rows = keyed.select(*by, "key", F.substring("key", 1, 4).alias("prefix"),
                        (weight if weight is not None else F.lit(1)).cast("long").alias("w"))
    totals = rows.groupBy(*by, "prefix").agg(F.sum("w").alias("w"))
    span = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("w").over(span.orderBy("prefix").rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0))
    edges = totals.select(*by, "prefix", "w", before.alias("before"), F.sum("w").over(span).alias("total"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), t.cast("long").alias("target"))
                                 for name, t in targets.items()]))
    edges = (
        edges.select("*", wanted.alias("t")).select("*", "t.name", "t.target").drop("t")
        .where((F.col("before") < F.col("target")) & (F.col("target") <= F.col("before") + F.col("w")))
        .select(*by, "prefix", "before", "name", "target")
    )
    # one row per group and target survives, and groups are the handful of splits
    inside = rows.join(F.broadcast(edges), [*by, "prefix"])
    running = F.col("before") + F.sum("w").over(W.partitionBy(*by, "prefix", "name").orderBy("key"))
    reached = inside.select(*by, "name", "key", "target", running.alias("running")) \
        .where(F.col("running") >= F.col("target"))
    return reached.groupBy(*by).agg(
        *[F.min(F.when(F.col("name") == name, F.col("key"))).alias(name) for name in targets]
    )


def global_rank(df: DataFrame, key: Column, name: str) -> DataFrame:
    """1-based rank of every row by a hex key, without a window over the whole table.

    Rows are ranked inside their 4-digit key prefix and shifted by the totals of the prefixes
    before it; the table of totals has at most 65,536 rows.
    """
    rows = df.withColumn("rank_key", key).withColumn("prefix", F.substring("rank_key", 1, 4))
    totals = rows.groupBy("prefix").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("prefix").rowsBetween(W.unboundedPreceding, -1))
    shifts = totals.select("prefix", F.coalesce(before, F.lit(0)).alias("shift"))
    inside = F.row_number().over(W.partitionBy("prefix").orderBy("rank_key"))
    return rows.withColumn("inside", inside).join(F.broadcast(shifts), "prefix").withColumn(
        name, F.col("inside") + F.col("shift")).drop("prefix", "rank_key", "inside", "shift")


def large_groups(df: DataFrame, keys: list[str], order: Column, slice_rows: int) -> DataFrame | None:
    """(keys, group_rows) of the groups above ``slice_rows``, or None. Reads key columns only."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("group_rows")).where(F.col("group_rows") > slice_rows)
    table = materialize(sizes, "large-groups")
    return None if table.isEmpty() else table


def positions(df: DataFrame, keys: list[str], order: Column, ties: list[str], name: str,
              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """1-based position of each row in its group by (order, ties), nulls last."""
    large = large_groups(df, keys, order, slice_rows)
    if large is None:
        sequence = W.partitionBy(*keys).orderBy(order.asc_nulls_last(), *ties)
        return df.withColumn(name, F.row_number().over(sequence))
    return sliced_positions(df, keys, order, ties, name, large, slice_rows)


def sliced_positions(df: DataFrame, keys: list[str], order: Column, ties: list[str], name: str,
                     large: DataFrame, slice_rows: int) -> DataFrame:
    """Positions when some groups are large.

    Rows of the groups in ``large`` are dealt by range of (keys, order, ties) over tasks and cut there, in order,
    into slices of ``slice_rows`` rows, so equal or missing orders are cut as well. A task takes many
    slices where they are small: the number of tasks follows the rows, not the slices. Every slice is
    numbered alone and shifted by the sizes of the group's slices before it.
    """
    sequence = [order.asc_nulls_last(), *ties]
    rows = large.agg(F.sum("group_rows")).first()[0]
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2, min(-(-rows // slice_rows), max(usual, -(-rows // SLICE_ROWS))))
    marked = df.join(broadcast_if_small(large.withColumn("sliced", F.lit(True)).drop("group_rows")), keys, "left")
    small = marked.where("sliced is null").withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*sequence)))
    dealt = marked.where("sliced").repartitionByRange(parts, *keys, *sequence).sortWithinPartitions(*keys, *sequence)
    # the number holds the partition in its upper bits and the place there, from 0, in the lower 33
    number = F.monotonically_increasing_id()
    place = number.bitwiseAND((1 << 33) - 1)
    dealt = materialize(dealt.withColumn("slice", number - place % slice_rows), "slices")
    sizes = dealt.groupBy(*keys, "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(*keys).orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    shifts = materialize(sizes.select(*keys, "slice", F.coalesce(before, F.lit(0)).alias("shift")), "slice-shifts")
    in_slice = F.row_number().over(W.partitionBy(*keys, "slice").orderBy(*sequence))
    numbered = dealt.withColumn("in_slice", in_slice).join(broadcast_if_small(shifts), [*keys, "slice"])
    numbered = numbered.withColumn(name, (F.col("in_slice") + F.col("shift")).cast("int"))
    return numbered.drop("in_slice", "shift", "slice", "sliced").unionByName(small.drop("sliced"))


#: Distinct values that the last step of a median orders, and ranges counted to get there.
MEDIAN_VALUES, RANGES = 100_000, 4096


def exact_median(df: DataFrame, value: str, most: int = MEDIAN_VALUES) -> DataFrame:
    """One row, one column ``median``: the exact median without gathering all values.

    Equal values collapse first. While more than ``most`` are left, they are counted in ``RANGES`` ranges
    of equal width, and only the ranges that hold the middle ranks go on. Finite values only.
    """
    values = materialize(df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
                         .groupBy("v").agg(F.count("*").alias("n")), "median-values")
    total, distinct, lo, hi = values.agg(F.sum("n"), F.count("*"), F.min("v"), F.max("v")).first()
    if not distinct:
        return df.sparkSession.createDataFrame([(None,)], "median double")
    ranks, below, inside = ((total + 1) // 2, total // 2 + 1), 0, values
    while distinct > most and lo < hi:
        place = F.least(F.floor((F.col("v") - lo) / (hi - lo) * RANGES), F.lit(RANGES - 1))
        counted = inside.groupBy(place.alias("place")).agg(
            F.sum("n").alias("n"), F.count("*").alias("distinct"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before, kept = below, []
        for part in sorted(counted.collect()):  # one row per range
            if any(before < rank <= before + part["n"] for rank in ranks):
                below = before if not kept else below
                kept.append(part)
            before += part["n"]
        distinct, lo, hi = sum(p["distinct"] for p in kept), kept[0]["lo"], kept[-1]["hi"]
        inside = inside.where(F.col("v").between(lo, hi))
    upto = F.lit(below) + F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("v"))
    ranked = inside.select("v", upto.alias("upto"), "n")
    holds = lambda rank: (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
    middle = [F.max(F.when(holds(rank), F.col("v"))) for rank in ranks]
    return ranked.agg(((middle[0] + middle[1]) / 2).alias("median"))
