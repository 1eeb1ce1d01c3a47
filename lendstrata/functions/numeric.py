"""Numeric expressions for gold features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio for a positive denominator, 0.0 for any other (NULL included)."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def indicator(c: Column, value: str) -> Column:
    """1 on an exact, case-sensitive match, else 0 (NULL included)."""
    return F.when(c == value, F.lit(1)).otherwise(F.lit(0))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
