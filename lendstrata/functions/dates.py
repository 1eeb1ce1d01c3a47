"""Date expressions and the snapshot calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# How the sources spell their dates.
ISO_DATE = "yyyy-MM-dd"
SHORT_US_DATE = "M/d/yy"


def parse_date(c: Column, fmt: str = ISO_DATE) -> Column:
    """Text to date; text that does not follow ``fmt`` becomes NULL."""
    return F.try_to_date(c, fmt)


def first_of_month(c: Column) -> Column:
    return F.trunc(c, "month")


def month_spine(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One ``snapshot_date`` row for each first of month from ``start`` to ``end``.

    ``bounds`` holds the two date columns. The month of the start counts even when
    the start is not its first day; a row whose end lies before that first gives nothing.
    """
    first, last = first_of_month(F.col(start)), F.col(end)
    months = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("snapshot_date"))


def month_spine_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return month_spine(bounds, "start", "end")
