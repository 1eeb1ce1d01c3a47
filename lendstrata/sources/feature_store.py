"""Per-snapshot features: one table partitioned by snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.sources.files import read_table, slice_snapshots, write_snapshots
from lendstrata.sources.specs import SNAPSHOT


def read_features(spark: SparkSession, path: str, snapshot: date) -> DataFrame:
    """Features of one snapshot; other partitions are not opened."""
    return slice_snapshots(read_table(spark, path), [snapshot])


def write_features(df: DataFrame, path: str, snapshot: date) -> None:
    """Replace the features of one snapshot."""
    write_snapshots(df.withColumn(SNAPSHOT, F.lit(snapshot).cast("date")), path)
