"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def unpivot(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per key row and column, NULL values kept. A narrow operation; filters on
    the value are not pushed below it, so only the needed columns are passed in."""
    quoted = [f"`{c}`" for c in columns]
    return df.select(*keys, *quoted).unpivot(list(keys), quoted, name, value)
