"""Column quantiles and the inter-quartile outlier filter.

``quantiles`` finds them for all columns at once by narrowing ranges. One scan counts rows in
a coarse histogram and finds the cell of each wanted rank; each further scan counts the rows
of the found ranges in ``PARTS`` equal parts, until a range holds a single value, or no more
rows than the wanted error allows. Every scan is a grouped count that is combined before its
shuffle; neither a task nor the driver sees more groups than that, however many values are
close together. Doubles leave room for about six scans. Rows may have weights, so repeated
rows need not be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendstrata.functions.numeric import nan_to_null
from lendstrata.operators.reshape import unpivot

CELLS_PER_LOG_UNIT = 64
LARGEST_LOG = 710.0  # log1p of the largest double is below this
PARTS = 2048


@dataclass(frozen=True)
class Range:
    """Where a quantile lies: from ``low`` to ``high``, the ``rank``-th of ``n`` rows there."""

    column: str
    i: int
    low: float
    high: float
    rank: int
    n: int
    total: int

    def settled(self, relative_error: float) -> bool:
        return self.low == self.high or self.n <= relative_error * self.total


def _cell(value: Column) -> Column:
    """Monotone map of a double to one of about 90,000 cells, each under 2 % wide."""
    size = F.least(F.log1p(F.abs(value)), F.lit(LARGEST_LOG))
    return F.floor(F.signum(value) * size * CELLS_PER_LOG_UNIT).cast("int")


def _summed(values: DataFrame, groups: list[str]) -> DataFrame:
    """By cell of each group: its rows, least and largest value, and the rows up to its end."""
    upto = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = values.groupBy(*groups, "_cell").agg(
        F.sum("_w").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    return counted.withColumn("_upto", F.sum("_n").over(upto))


def _located(values: DataFrame, probabilities: Sequence[float]) -> list[Range]:
    """The cell of the coarse histogram for each column and probability."""
    whole = Window.partitionBy("_column")
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)))
    found = (
        _summed(values.withColumn("_cell", _cell(F.col("_value"))), ["_column"])
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_want", F.explode(wanted))
        .withColumn("_rank", F.greatest(F.lit(1), F.ceil(F.col("_want.p") * F.col("_total"))))
        .filter("_rank <= _upto and _rank > _upto - _n")
        .selectExpr("_column", "_want.i", "_low", "_high", "_rank - (_upto - _n)", "_n", "_total")
    )
    return [Range(*r) for r in found.collect()]  # one row per column and probability


def _narrowed(values: DataFrame, ranges: list[Range]) -> list[Range]:
    """For each range the one of its parts that holds the rank; its ends are values."""
    known = values.sparkSession.createDataFrame(
        [(r.column, r.i, r.low, r.high, r.rank) for r in ranges],
        "_column string, _i int, _from double, _to double, _rank bigint",
    )
    # halved, as the difference of two large doubles may have no double; beside an infinite
    # end, or between neighbours, everything but the ends is in the middle
    value, low, high = F.col("_value"), F.col("_from"), F.col("_to")
    place = F.coalesce(F.nanvl(F.try_divide(value / 2 - low / 2, high / 2 - low / 2), F.lit(0.5)), F.lit(0.5))
    part = F.least(F.floor(place * PARTS), F.lit(PARTS - 1)).cast("int")
    inside = (
        values.join(F.broadcast(known), "_column")
        .filter("_value between _from and _to")
        .withColumn("_cell", F.when(value == low, 0).when(value == high, PARTS - 1).otherwise(part))
    )
    found = (
        _summed(inside, ["_column", "_i", "_rank"])
        .filter("_rank <= _upto and _rank > _upto - _n")
        .selectExpr("_column", "_i", "_low", "_high", "_rank - (_upto - _n)", "_n")
    )
    totals = {(r.column, r.i): r.total for r in ranges}
    return [Range(*r, totals[r[0], r[1]]) for r in found.collect()]


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
    weight: str | None = None,
) -> DataFrame:
    """One row with an array of discrete quantiles per column.

    With ``relative_error`` 0 a quantile is the least value whose cumulative weight reaches
    ``p`` of the total; else it is a value that is off in rank by at most that part of the
    total. NULL and NaN do not count; a column without values has NULLs.
    """
    if relative_error < 0:
        raise ValueError("relative_error must not be negative")
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    numeric = df.select(w.alias("_w"), *(nan_to_null(F.col(c).cast("double")).alias(c) for c in columns))
    values = unpivot(numeric.filter("_w > 0"), ["_w"], columns, "_column", "_value").filter("_value is not null")
    done: list[Range] = []
    todo = _located(values, probabilities)
    while todo:
        done += [r for r in todo if r.settled(relative_error)]
        todo = [r for r in todo if not r.settled(relative_error)]
        todo = _narrowed(values, todo) if todo else []
    found = {(r.column, r.i): r.low for r in done}
    row = tuple([found.get((c, i)) for i in range(len(probabilities))] for c in columns)
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{c}` array<double>" for c in columns))


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    relative_error: float = 0.01,
    weight: str | None = None,
) -> DataFrame:
    """One row with a struct (lower, upper) per column: the quartiles widened by ``k``
    inter-quartile ranges. ``relative_error=0`` asks for exact quartiles."""
    quartiles = [0.25, 0.75]
    stats = quantiles(df, columns, quartiles, relative_error, weight)

    def fence(c: str) -> Column:
        q1, q3 = F.get(c, F.lit(0)), F.get(c, F.lit(1))
        return F.struct((q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper")).alias(c)

    return stats.select(*(fence(c) for c in columns))


Fences = Mapping[str, tuple[float | None, float | None]]


def iqr_fences(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    relative_error: float = 0.01,
    weight: str | None = None,
) -> Fences:
    """The fences of those columns that are present, as numbers; None for one without values."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    bounds = iqr_bounds(df, present, k, relative_error, weight).first()
    return {c: (bounds[c].lower, bounds[c].upper) for c in present}


def within_fences(df: DataFrame, fences: Fences) -> DataFrame:
    """Rows whose values lie within all the fences; NULL and NaN lie outside, and a column
    without fences puts no condition. The numbers reach a Parquet scan as pushed filters."""
    inside = [
        (F.col(c) >= F.lit(lower)) & (F.col(c) <= F.lit(upper))
        for c, (lower, upper) in fences.items()
        if lower is not None and upper is not None
    ]
    return df.filter(reduce(and_, inside)) if inside else df


def iqr_filter(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    relative_error: float = 0.01,
    weight: str | None = None,
) -> DataFrame:
    """Rows whose value lies within the fences in all the columns that are present.

    Costly input should be a stored table, as it is read once for the fences and once for the
    rows.
    """
    return within_fences(df, iqr_fences(df, columns, k, relative_error, weight))
