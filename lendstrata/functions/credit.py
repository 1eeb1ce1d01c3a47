"""Delinquency arithmetic on one loan snapshot."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole installments covered by the overdue amount; 0 when nothing falls due."""
    return F.when(due > 0, F.ceil(overdue / due).try_cast("int")).otherwise(F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Snapshot moved back by the missed months (clamped to month end), else NULL."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed date; 0 when nothing is overdue.

    NULL when an amount is overdue although no installment was due.
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0)).cast("int")


def default_label(dpd: Column, threshold: int, null_label: int = 0) -> Column:
    """1 from ``threshold`` days past due on, else 0; unknown dpd gets ``null_label``."""
    return F.when(dpd >= threshold, F.lit(1)).when(dpd.isNull(), F.lit(null_label)).otherwise(F.lit(0))
