"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(value: Column | str, digits: int) -> Column:
    """Round ties to even, as reported rates and scores are; ``F.round`` rounds ties up."""
    scale = F.lit(float(10**digits))
    return F.rint((F.col(value) if isinstance(value, str) else value) * scale) / scale
