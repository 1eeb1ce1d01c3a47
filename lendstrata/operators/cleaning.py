"""Cleaning of wide records: typed columns, flags, complete cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from lendstrata.functions import text


def cast_columns(
    df: DataFrame, floats: Sequence[str] = (), ints: Sequence[str] = (), strip: bool = True
) -> DataFrame:
    """Cast columns in one projection. Text goes through the lenient readers, a column
    that is numeric already is cast directly and never passes through text."""

    def read(name: str, to: str) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, NumericType):
            return c.try_cast(to)
        return (text.lenient_float if to == "float" else text.lenient_int)(c, strip)

    return df.withColumns(
        {c: read(c, "float") for c in floats} | {c: read(c, "int") for c in ints}
    )


def multi_hot(df: DataFrame, source: str, vocabulary: Sequence[str], prefix: str = "Has_") -> DataFrame:
    """One int flag per vocabulary entry of a delimited list; the list column goes.

    A NULL list gives NULL flags, an empty one zeros. Repeats and empty items make no
    difference to membership, so the plain split is searched.
    """
    listed = df.withColumn("_items", text.split_list(F.col(source)))
    flags = {flag_name(v, prefix): F.array_contains("_items", v).cast("int") for v in vocabulary}
    return listed.withColumns(flags).drop("_items", source)


def flag_name(entry: str, prefix: str = "Has_") -> str:
    return prefix + entry.replace(" ", "_")


def complete_cases(df: DataFrame) -> DataFrame:
    """Rows without any NULL (and without NaN in floating columns)."""
    return df.dropna()


def null_counts(df: DataFrame) -> list[Column]:
    """Row count and, per column, the number of rows that column alone would cost.

    Meant for ``DataFrame.observe``: the figures come with the write, not with a job of their own.
    """
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns]
    return [F.count(F.lit(1)).alias("rows"), *counts]
