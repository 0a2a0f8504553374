"""Equi-join whose hot keys are split over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.session import broadcast_if_small, materialize

#: Rows of one key that a single join task may take.
HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(key, salts) of the keys with more than ``hot_rows`` rows, or None; reads the key column only."""
    counts = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    table = materialize(counts.select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("salts")), "hot-keys")
    return None if table.isEmpty() else table


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of many rows with a table that is unique in ``key``.

    Rows of a hot key are spread by the hash of their id ``spread`` over salts, and the one matching
    row is repeated per salt. This holds where the adaptive skew join does not act: when a further
    join or aggregate on the same key follows. Without hot keys it is the plain join.
    """
    hot = hot_keys(left, key, hot_rows)
    if hot is None:
        return left.join(right, key)
    hot = broadcast_if_small(hot)
    salts = F.coalesce("salts", F.lit(1))
    salted = left.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(spread), salts).cast("int"))
    repeated = right.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("salts").join(repeated.drop("salts"), [key, "salt"]).drop("salt")
