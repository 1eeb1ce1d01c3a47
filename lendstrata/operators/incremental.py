"""Which rows and snapshots are new.

Row comparisons put both sides into one union and group it, so copies are combined
before the shuffle and one value that fills a third of either side is no hot spot.
Grouping compares NULL with NULL as equal, as INTERSECT and EXCEPT do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lendstrata.operators.skew import replicate_rows


def row_text(columns: Sequence[str], separator: str = "_") -> Column:
    """All columns as one text. NULLs leave no trace and the separator may occur in the
    data, so different rows can agree: see ``row_digest``."""
    return F.concat_ws(separator, *columns)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns with their names, NULLs included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _copies_per_side(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    columns = incoming.columns
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = incoming.select("*", one.alias("_new"), none.alias("_old")).unionByName(
        stored.select(*columns, none.alias("_new"), one.alias("_old"))
    )
    return both.groupBy(*columns).agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))


def common_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct rows found on both sides."""
    return _copies_per_side(incoming, stored).filter("_new > 0 and _old > 0").drop("_new", "_old")


def new_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows that are not stored yet, each as often as it came in."""
    fresh = _copies_per_side(incoming, stored).filter("_new > 0 and _old = 0").drop("_old")
    return replicate_rows(fresh, "_new")


def load_state(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: distinct incoming rows, how many of them are stored, and whether all are."""
    return (
        _copies_per_side(incoming, stored)
        .filter("_new > 0")
        .agg(F.count(F.lit(1)).alias("incoming_rows"), F.count_if(F.col("_old") > 0).alias("stored_rows"))
        .withColumn("already_loaded", F.expr("incoming_rows = stored_rows"))
    )


def missing_snapshots(wanted: DataFrame, stored: DataFrame, on: str = "snapshot_date") -> DataFrame:
    """Wanted snapshots of which nothing is stored."""
    return wanted.select(on).distinct().join(stored.select(on).distinct(), on, "left_anti")
