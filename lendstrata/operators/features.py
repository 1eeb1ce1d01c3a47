"""Columns derived from others, each stated as what it needs and how it follows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lendstrata.functions.numeric import guarded_ratio


@dataclass(frozen=True)
class Derived:
    """A new column, the columns that it needs, and its formula over them."""

    name: str
    needs: tuple[str, ...]
    formula: Callable[..., Column]


def derive(df: DataFrame, wanted: Iterable[Derived]) -> DataFrame:
    """``df`` with each wanted column all of whose needs it has; the others are left out."""
    possible = {d.name: d.formula(*map(F.col, d.needs)) for d in wanted if not {*d.needs} - {*df.columns}}
    return df.withColumns(possible) if possible else df


def logarithm(column: str, origin: Column | None = None) -> Derived:
    """``log1p`` of a column, NULL for arguments of -1 and below; with an ``origin`` the column
    is moved so that this value lands on 1 first."""
    return Derived(
        f"{column}_Log", (column,), lambda value: F.log1p(value if origin is None else value - origin + F.lit(1))
    )


def ratio(name: str, numerator: str, denominator: str) -> Derived:
    """A quotient that is 0 where its denominator is not positive."""
    return Derived(name, (numerator, denominator), guarded_ratio)


def least_value(df: DataFrame, column: str) -> Column:
    """The least value of a column, as a scalar subquery with partial aggregation; ``df`` should
    be a stored table when it is costly to compute."""
    return df.agg(F.min(column).cast("double")).scalar()
