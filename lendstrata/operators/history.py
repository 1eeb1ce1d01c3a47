"""Attributes over time: intervals in which they stay the same, and lookups as of a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lendstrata.operators.skew import skew_join

FROM, TO = "valid_from", "valid_to"


def validity_intervals(rows: DataFrame, key: str, day: str, attributes: Sequence[str]) -> DataFrame:
    """``key, attributes..., valid_from, valid_to``: one row for each stretch of days on which a
    key keeps its attributes; ``valid_to`` is the day of the next stretch, NULL for the last.

    Of several rows of a key and day the one with the least attributes counts, chosen by an
    aggregate that is combined before its shuffle; what is left of a key is at most one row for
    each day of the calendar. NULLs are values like others. A day without a row of a key
    neither ends nor begins a stretch.
    """
    state = F.struct(*attributes)
    daily = rows.groupBy(key, day).agg(F.min(state).alias("_state"))
    in_time = Window.partitionBy(key).orderBy(day)
    before = F.lag("_state").over(in_time)
    begins = F.row_number().over(in_time).eqNullSafe(1) | ~F.col("_state").eqNullSafe(before)
    starts = daily.withColumn("_begins", begins).where("_begins")
    return starts.select(
        key, *(F.col(f"_state.{a}").alias(a) for a in attributes), F.col(day).alias(FROM), F.lead(day).over(in_time).alias(TO)
    )


def as_of(rows: DataFrame, intervals: DataFrame, key: str, day: str, attributes: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the attributes that hold on their day, in one row each.

    The distinct keys and days of ``rows`` and the starts of the intervals are put in one order
    by key and day, and each takes the last start before it: a window over at most two rows
    for each key and day, and no range join. The result is joined back to the rows by key and
    day, and keys with a large share of the rows are dealt over buckets there. Rows from before
    their key's first interval are left out, or get NULLs with ``how="left"``.
    """
    state = F.struct(*attributes, F.col(FROM))
    starts = intervals.select(key, F.col(FROM).alias(day), state.alias("_state"), F.lit(0).alias("_asked"))
    asked = rows.select(key, day).distinct().select(key, day, F.lit(None).cast(starts.schema["_state"].dataType).alias("_state"), F.lit(1).alias("_asked"))
    upto = Window.partitionBy(key).orderBy(day, "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = starts.union(asked).withColumn("_state", F.last("_state", ignorenulls=True).over(upto))
    held = found.where("_asked = 1 and _state is not null").select(key, day, *(F.col(f"_state.{a}").alias(a) for a in [*attributes, FROM]))
    return skew_join(rows, held, [key, day], how, hot_right={})
