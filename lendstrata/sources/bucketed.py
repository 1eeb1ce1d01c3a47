"""Tables that are bucketed by the keys they are joined on, so that joins need no shuffle.

Rows are dealt out once, when a table is written, into one sorted file for each bucket. Tables
with the same keys and number of buckets then join bucket by bucket, as often as they are read.
Buckets cannot be split: a key with a large share of the rows makes one large bucket, which
``bucket_rows`` shows; joins of such tables are better left to ``skew_join``.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F


ROWS_PER_BUCKET = 1_000_000


def buckets_for(tables: Sequence[DataFrame], least: int) -> int:
    """Buckets for tables that are to be joined: as many as the longest needs for its buckets to
    be sorted in memory, a multiple of ``least``."""
    longest = max(t.count() for t in tables)
    return least * max(1, ceil(longest / (least * ROWS_PER_BUCKET)))


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as the bucketed table ``name`` of the session's catalog, in place
    of an earlier one, and return a scan of it."""
    dealt = df.repartition(buckets, *keys)  # the hash that tells a bucket tells the partition
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_rows(table: DataFrame, keys: Sequence[str], buckets: int, factor: float = 4.0) -> DataFrame:
    """``bucket, row_count, skewed`` of each bucket that holds rows; skewed ones hold more than
    ``factor`` times an even share. Counts are combined before their shuffle."""
    counted = table.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))
    even = F.lit(table.agg(F.count(F.lit(1)) / buckets).scalar())
    return counted.withColumn("skewed", F.col("row_count") > F.lit(factor) * even)
