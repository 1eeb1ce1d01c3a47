"""Session settings the library is measured with. All are ordinary Spark settings; results
do not depend on any of them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

TUNING = {
    # Wide cleaning projections compile to methods beyond HotSpot's 8,000-byte JIT limit and
    # would be interpreted. Past this limit Spark generates split, compilable methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tasks that write a few partitions keep their files open instead of sorting their rows.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    return builder


#: What a run sets for itself where its session leaves it open. A task then writes its snapshots
#: side by side, in columns; if it sorted its rows by snapshot first, it would spill, as rows
#: take ten times the room that they have in Parquet.
LOADING = {
    "spark.sql.codegen.hugeMethodLimit": TUNING["spark.sql.codegen.hugeMethodLimit"],
    "spark.sql.maxConcurrentOutputFileWriters": "200",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def loading(spark: SparkSession) -> Iterator[None]:
    """The settings of ``LOADING`` for the jobs that are run inside the block."""
    free = [key for key in LOADING if spark.conf.get(key, None) is None]
    for key in free:
        spark.conf.set(key, LOADING[key])
    try:
        yield
    finally:
        for key in free:
            spark.conf.unset(key)
